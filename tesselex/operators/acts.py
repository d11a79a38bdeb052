"""Metadata of acts, downloads and their failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesselex.functions import metadata as M

DEFAULT_AUTHOR = "ANEEL"


def files(records: DataFrame) -> DataFrame:
    """A row per file of each record, in source position; records without files give none."""
    return records.select(
        "registro_meta_id", "ano_json", "titulo", "ementa", "assunto", "situacao", "publicacao", "autor", F.posexplode("pdfs").alias("posicao", "pdf")
    ).select("*", "pdf.url", "pdf.arquivo", "pdf.tipo").drop("pdf")


def download_tasks(records: DataFrame) -> DataFrame:
    """(ano_json, url, nome_arquivo) of every file with a URL; an empty name is taken from the URL."""
    f = files(records).where(F.coalesce("url", F.lit("")) != "")
    return f.select("registro_meta_id", "posicao", "ano_json", "url", F.coalesce(F.nullif("arquivo", F.lit("")), M.file_of_url(F.col("url"))).alias("nome_arquivo"))


def lookup(records: DataFrame) -> DataFrame:
    """Metadata by file name. Of several, the last in source order (year, record, position) wins."""
    w = Window.partitionBy("arquivo").orderBy(F.desc_nulls_last("ano_json"), F.desc("registro_meta_id"), F.desc("posicao"))
    last = files(records).where(F.coalesce("arquivo", F.lit("")) != "").withColumn("__n", F.row_number().over(w)).where("__n = 1")
    when = M.iso_date(F.col("publicacao"))
    return last.select(
        "arquivo",
        M.act_id(F.col("arquivo")).alias("ato_id"),
        M.document_type(F.col("tipo")).alias("tipo_documento"),
        *[M.clean_field(F.col(c)).alias(c) for c in ("titulo", "ementa", "assunto", "situacao")],
        when.alias("publicacao"),
        F.coalesce(F.nullif("autor", F.lit("")), F.lit(DEFAULT_AUTHOR)).alias("autor"),
        F.coalesce(F.substring(when, 1, 4).try_cast("int"), F.col("ano_json")).alias("ano"),
        "ano_json",
    )


_FOUND = ("ato_id", "tipo_documento", "titulo", "ementa", "assunto", "situacao", "publicacao", "autor", "ano", "ano_json")


def with_metadata(documents: DataFrame, found: DataFrame, *keep: str) -> DataFrame:
    """Every document by file name with its metadata and the columns `keep`; the act of the file's name, the type "outro"
    and the usual author where the name is unknown.
    """
    m = found.select(F.col("arquivo").alias("__file"), *[F.col(c).alias(f"m_{c}") for c in _FOUND])
    out = documents.join(m, F.col("arquivo_origem") == F.col("__file"), "left")
    default = {"ato_id": M.act_id(F.col("arquivo_origem")), "tipo_documento": F.lit("outro"), "autor": F.lit(DEFAULT_AUTHOR)}
    return out.select("registro_id", "arquivo_origem", *keep, *[F.coalesce(f"m_{c}", default[c]).alias(c) if c in default else F.col(f"m_{c}").alias(c) for c in _FOUND])


def missing(records: DataFrame, listing: DataFrame, name: str) -> DataFrame:
    """(arquivo, caminho, ato_id): files that the records name and a listing (a column of file names) does not have, each
    once; caminho is year and name.
    """
    wanted = files(records).where(F.coalesce("arquivo", F.lit("")) != "").select(
        "arquivo", F.concat_ws("/", F.col("ano_json").cast("string"), F.col("arquivo")).alias("caminho")
    ).distinct()
    have = listing.select(F.col(name).alias("arquivo")).distinct()
    return wanted.join(have, "arquivo", "left_anti").select("arquivo", "caminho", M.act_id(F.col("arquivo")).alias("ato_id"))


def failed_urls(log: DataFrame) -> DataFrame:
    """(url, falha_id) of each repaired URL once, at its first place in the log."""
    return log.select("falha_id", M.last_url(F.col("url")).alias("url")).where("url is not null").groupBy("url").agg(F.min("falha_id").alias("falha_id"))


def retry_plan(log: DataFrame, records: DataFrame) -> DataFrame:
    """Repaired URLs with year and file name: of the metadata where the URL is known (last wins), else from the URL, the
    year "outros" where it shows none.
    """
    t = download_tasks(records)
    w = Window.partitionBy("url").orderBy(F.desc_nulls_last("ano_json"), F.desc("registro_meta_id"), F.desc("posicao"))
    known = t.withColumn("__n", F.row_number().over(w)).where("__n = 1").select("url", F.col("ano_json").cast("string").alias("ano"), "nome_arquivo")
    year = F.nullif(F.regexp_extract("url", "(2016|2021|2022)", 1), F.lit(""))
    return failed_urls(log).join(known, "url", "left").select(
        "url", "falha_id", F.coalesce("ano", year, F.lit("outros")).alias("ano"),
        F.coalesce("nome_arquivo", M.file_of_url(F.col("url"))).alias("nome_arquivo")
    )


def failure_counts(log: DataFrame) -> DataFrame:
    """Failures by label, the label derived anew from the status or message."""
    status = F.nullif(F.regexp_extract("motivo", "HTTP_([0-9]{3})", 1), F.lit("")).try_cast("int")
    return log.select(M.failure(status, F.col("motivo")).alias("rotulo")).groupBy("rotulo").agg(F.count("*").alias("falhas"))


def pending(all_of: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the ledger `done`. A null key is pending."""
    return all_of.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def selected(all_of: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in an explicit list."""
    return all_of.join(wanted.select(key).distinct(), key, "left_semi")
