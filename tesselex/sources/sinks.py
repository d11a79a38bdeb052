"""Writers of documents, chunks, vectors and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesselex.functions.metadata import file_stem


def write_documents(documents: DataFrame, path: str, kind: str = "json") -> None:
    """Documents by year. One of each (ano, zip_pai, file stem, type) is kept, the last received, as a later file of that
    name replaces an earlier one; archives are told apart.
    """
    w = Window.partitionBy(
        F.coalesce("ano", F.lit(0)), F.coalesce("zip_pai", F.lit("")), file_stem(F.col("arquivo_origem")), "tipo_documento"
    ).orderBy(F.desc_nulls_last("recebido_em"), F.desc("registro_id"))
    last = documents.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    last.write.mode("overwrite").partitionBy("ano").format(kind).save(path)


def write_read_documents(documents: DataFrame, path: str) -> None:
    """Documents read from scans as JSON by year, beside those of write_documents: the file's name keeps its kind (stem,
    "_ocr_", type) as a column and folder, the year of the metadata stands in for a missing one, and every row is kept.
    """
    name = F.concat_ws("_", file_stem(F.col("arquivo_origem")), F.lit("ocr"), "tipo_documento")
    rows = documents.withColumn("nome", name).withColumn("ano", F.coalesce(F.nullif("ano", F.lit(0)), "ano_json"))
    rows.drop("ano_json").write.mode("append").partitionBy("ano").json(path)


def write_chunks(children: DataFrame, folder: str) -> None:
    """Children and their parents as two tables by year."""
    children.write.mode("overwrite").partitionBy("ano").parquet(f"{folder}/filhos")
    parents = children.select("registro_id", "chunk_pai_id", "chunk_id", "ato_id", "tipo_documento", "ano", "numero_chunk", "total_chunks", "texto_pai")
    parents.write.mode("overwrite").partitionBy("ano").parquet(f"{folder}/pais")


def write_index(rows: DataFrame, path: str) -> None:
    """Snappy parquet, sorted by type and year within files so that their statistics serve as payload indexes."""
    rows.sortWithinPartitions("tipo_documento", "ano").write.mode("overwrite").option("compression", "snappy").parquet(path)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of `new`, and those of `old` whose key it does not have."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def write_summary(report: DataFrame, path: str) -> None:
    """A report of a few rows (counts, errors, files left out) as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def append_ledger(keys: DataFrame, column: str, path: str) -> None:
    keys.select(F.col(column).cast("string").alias("value")).where("value is not null").write.mode("append").text(path)
