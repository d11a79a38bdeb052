"""The pN_ queries: each problem's operator over its whole tables, and their SQL where DuckDB can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselex.llm import encoding, near_dup, packing, residue, scan_noise, site_lines, splitting, tokens
from tesselex.llm.sql import SQL  # noqa: F401 - the driver's entry takes it from here
from tesselex.plans.lineage import ready
from tesselex.sources.tables import table

CAPACITY = 2048
CHUNK_LIMITS = {"texto": 1200, "texto_pai": 2400}
DOCUMENT_LIMITS = {"texto": 6000}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return near_dup.pairs(table(ready(spark), d, "corpus_documentos"), "registro_id", "texto")


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_dup.groups(table(ready(spark), d, "corpus_documentos"), "registro_id", "texto")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return site_lines.repeated_lines(table(ready(spark), d, "corpus_documentos"), "registro_id", "tipo_documento", "texto")


def p2_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return site_lines.without_lines(table(ready(spark), d, "corpus_documentos"), "registro_id", "tipo_documento", "texto")


def _oversized(spark: SparkSession, d: str, with_text: bool) -> DataFrame:
    chunks = splitting.split_oversized(table(ready(spark), d, "chunks_hierarquicos"), "row_id", CHUNK_LIMITS, "chunks_hierarquicos", with_text=with_text)
    return chunks.unionByName(splitting.split_oversized(table(spark, d, "corpus_documentos"), "registro_id", DOCUMENT_LIMITS, "corpus_documentos", with_text=with_text))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _oversized(spark, d, False).where("parte = 0 and partes > 1").select("tabela", "item_id", "campo")


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _oversized(spark, d, True)


def p3_rejoined(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of every oversized field joined again without their repeats, and whether all keep the limit and the
    overlap. A text's pieces meet in one row, as its text did.
    """
    limits = F.when(F.col("campo") == "texto_pai", CHUNK_LIMITS["texto_pai"]).when(
        F.col("tabela") == "corpus_documentos", DOCUMENT_LIMITS["texto"]
    ).otherwise(CHUNK_LIMITS["texto"])
    own = F.struct("parte", F.expr("substring(texto, corte - inicio + 1)").alias("novo"))
    fits = (F.length("texto") <= limits) & (F.col("fim") - F.col("inicio") == F.length("texto"))
    repeats = (F.col("corte") - F.col("inicio")).between(0, splitting.OVERLAP) & ((F.col("parte") > 0) | (F.col("corte") == 0))
    by = p3_pieces(spark, d).groupBy("tabela", "item_id", "campo").agg(
        F.array_sort(F.collect_list(own)).alias("p"), F.min(fits).alias("cabem"), F.min(repeats).alias("repetem")
    )
    return by.select("tabela", "item_id", "campo", F.array_join(F.transform("p", lambda x: x["novo"]), "").alias("texto"), "cabem", "repetem")


def _garbled(spark: SparkSession, d: str, restored: bool) -> DataFrame:
    return encoding.garbled_fields(table(ready(spark), d, "corpus_documentos"), "registro_id", ["texto", "ementa", "titulo"], restored=restored)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _garbled(spark, d, False).select("registro_id", "campo")


def p4_restored(spark: SparkSession, d: str) -> DataFrame:
    return _garbled(spark, d, True)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise.scan_noise(table(ready(spark), d, "corpus_documentos"), "registro_id", "texto")


def p5_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise.paragraphs(table(ready(spark), d, "corpus_documentos"), "registro_id", "texto")


def p6_chunks(spark: SparkSession, d: str) -> DataFrame:
    rows = tokens.first_of(table(ready(spark), d, "chunks_hierarquicos").select("row_id", "chunk_id", "tipo_documento", "ano", "texto"), "chunk_id", "row_id")
    return tokens.token_budget(rows, {"tipo_documento": F.col("tipo_documento"), "ano": F.col("ano")}, "texto")


def p6_documents(spark: SparkSession, d: str) -> DataFrame:
    by = tokens.token_budget(table(ready(spark), d, "documents"), {"source": F.col("source"), "lang": F.col("lang")}, "text")
    return by.join(table(spark, d, "fontes").select("source", "dominio"), "source", "left").select("source", "lang", "dominio", "registros", "tokens")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_ids(table(ready(spark), d, "documents"), "doc_id", "text")


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    docs = table(ready(spark), d, "documents")
    sizes = tokens.count_tokens(docs.where("length(text) > 0"), "doc_id", "text")
    return packing.pack(sizes, "doc_id", "n_tokens", CAPACITY, docs.count()).withColumnRenamed("item_id", "doc_id")


def p7_checksums(spark: SparkSession, d: str) -> DataFrame:
    """Number of ids of every row and a sum that depends on their order."""
    summed = F.aggregate(F.transform("ids", lambda x, i: x.cast("long") * (i + 1)), F.lit(0).cast("long"), lambda a, x: a + x)
    return p7_ids(spark, d).select("doc_id", F.size("ids").alias("n"), summed.alias("soma"))


def p8_totals(spark: SparkSession, d: str) -> DataFrame:
    """What was placed of every document: its tokens, its parts, and whether every container keeps its capacity and tells
    its unused room.
    """
    placed = p8_containers(spark, d)
    room = placed.groupBy("recipiente").agg(((F.sum("tamanho") + F.max("livre") == CAPACITY) & (F.min("livre") == F.max("livre")) & (F.min("livre") >= 0)).alias("cabe"))
    return placed.join(room, "recipiente").groupBy("doc_id").agg(F.sum("tamanho").alias("tokens"), F.count("*").alias("partes"), F.min("cabe").alias("cabe"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(table(ready(spark), d, "documents"), "doc_id", "source", "text").select("doc_id")


def p9_fit(spark: SparkSession, d: str) -> DataFrame:
    return residue.fit_for_use(table(ready(spark), d, "documents").select("doc_id", "source", "text"), "doc_id", "source", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_groups": p1_groups,
    "p2_found": p2_found,
    "p2_cleaned": p2_cleaned,
    "p3_found": p3_found,
    "p3_pieces": p3_pieces,
    "p3_rejoined": p3_rejoined,
    "p4_found": p4_found,
    "p4_restored": p4_restored,
    "p5_found": p5_found,
    "p5_paragraphs": p5_paragraphs,
    "p6_chunks": p6_chunks,
    "p6_documents": p6_documents,
    "p7_ids": p7_ids,
    "p7_checksums": p7_checksums,
    "p8_containers": p8_containers,
    "p8_totals": p8_totals,
    "p9_found": p9_found,
    "p9_fit": p9_fit,
}
