"""Queries of sources, sinks and streams: tables are written to the shared folder in a source's form and read back by its reader."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselex.functions import metadata as M
from tesselex.operators import acts, chunks, pages
from tesselex.plans.catalog import _CHILDREN, _FAILED, SQL, _chunks, _documents, _stem, parse_summary, query
from tesselex.plans.lineage import folder
from tesselex.sources import files, sinks
from tesselex.sources.tables import table
from tesselex.streaming.incremental import chunk_stream, failures_per_day

_LAST = f"""select * from corpus_documentos qualify row_number() over (partition by coalesce(ano, 0), coalesce(zip_pai, ''), {_stem('arquivo_origem')}, tipo_documento order by recebido_em desc nulls last, registro_id desc) = 1"""
_DOCUMENT = ("arquivo_origem", "ato_id", "tipo_documento", "titulo", "ano", "zip_pai", "texto", "tem_tabela", "paginas", "caracteres_extraidos", "ocr")


@query(f"select {', '.join(_DOCUMENT)}, coalesce(len(paginas_suspeitas), 0) as suspeitas from ({_LAST})")
def source_corpus_json(spark: SparkSession, d: str) -> DataFrame:
    """Documents written as JSON by year, the last of each name, and read again."""
    path = folder(spark, "corpus-json")
    sinks.write_documents(_documents(spark, d), path)
    return files.corpus_json(spark, path, lines=True).select(*_DOCUMENT, F.coalesce(F.size("paginas_suspeitas"), F.lit(0)).alias("suspeitas"))


@query(f"select arquivo_origem, tipo_documento, texto from ({_LAST}) where ano in (2016, 2021)")
def source_corpus_years(spark: SparkSession, d: str) -> DataFrame:
    """The same, folders of other years never opened."""
    path = folder(spark, "corpus-years")
    sinks.write_documents(_documents(spark, d), path)
    return files.corpus_json(spark, path, [2016, 2021], lines=True).select("arquivo_origem", "tipo_documento", "texto")


@query(f"with {_CHILDREN} select chunk_id, regexp_replace(chunk_id, '_c[0-9]+$', '') as arquivo_origem, numero_chunk, texto, texto_pai, ano from filhos")
def source_child_json(spark: SparkSession, d: str) -> DataFrame:
    """Children written as JSON with a folder a year and read from all of them."""
    path = folder(spark, "children-json")
    rows = chunks.children(_documents(spark, d))
    rows.withColumn("pasta", F.coalesce("ano", F.lit(0))).write.partitionBy("pasta").json(path)
    return files.child_json(spark, path, lines=True).select("chunk_id", "arquivo_origem", "numero_chunk", "texto", "texto_pai", "ano")


@query(f"with {_CHILDREN} select registro_id, chunk_pai_id, chunk_id, texto_pai from filhos")
def sink_parents(spark: SparkSession, d: str) -> DataFrame:
    """Children and parents written as two tables; the parents read again."""
    path = folder(spark, "chunk-tables")
    sinks.write_chunks(chunks.children(_documents(spark, d)), path)
    return spark.read.parquet(f"{path}/pais").select("registro_id", "chunk_pai_id", "chunk_id", "texto_pai")


@query(
    f"select registro_id, ({_stem('arquivo_origem')}) || '_ocr_' || tipo_documento as nome, coalesce(nullif(ano, 0), 2016) as ano, texto from corpus_documentos where ocr"
)
def sink_read_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents read from scans, written beside the others and read again."""
    path = folder(spark, "read-documents")
    rows = _documents(spark, d).where("ocr").select("registro_id", "arquivo_origem", "tipo_documento", "ano", "texto", F.lit(2016).alias("ano_json"))
    sinks.write_read_documents(rows, path)
    return spark.read.schema("registro_id long, nome string, texto string, ano int").json(path).select("registro_id", "nome", "ano", "texto")


@query("select tipo_documento, ano, count(*) as linhas, min(row_id) as primeira from chunks_hierarquicos group by 1, 2")
def sink_index(spark: SparkSession, d: str) -> DataFrame:
    """Index rows written sorted by type and year, counted from what was written."""
    path = folder(spark, "index")
    sinks.write_index(_chunks(spark, d).select("row_id", "tipo_documento", "ano"), path)
    return spark.read.parquet(path).groupBy("tipo_documento", "ano").agg(F.count("*").alias("linhas"), F.min("row_id").alias("primeira"))


@query("select vec_id, case when vec_id % 3 = 0 then label + 100 else label end as label from embeddings")
def sink_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Vectors brought up to date: a third of them come with a new label."""
    old = table(spark, d, "embeddings").select("vec_id", "label")
    return sinks.upsert(old, old.where("vec_id % 3 = 0").withColumn("label", F.col("label") + 100), "vec_id")


@query(SQL["parse_summary"])
def sink_summary(spark: SparkSession, d: str) -> DataFrame:
    """The summary of what was read, written as a report and read again."""
    path = folder(spark, "summary")
    report = parse_summary(spark, d)
    sinks.write_summary(report, path)
    return spark.read.schema(report.schema).json(path)


@query("select distinct arquivo_origem as chave from corpus_documentos where trim(arquivo_origem) <> ''")
def source_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Keys appended in two runs and read once each."""
    path = folder(spark, "ledger")
    for part in ("registro_id % 2 = 0", "true"):
        sinks.append_ledger(_documents(spark, d).where(part), "arquivo_origem", path)
    return files.ledger(spark, path, "chave")


@query(f"with {_FAILED} select url from falhas")
def source_failure_log(spark: SparkSession, d: str) -> DataFrame:
    """The log written as lines and repaired from them."""
    path = folder(spark, "failure-log")
    log = table(spark, d, "falhas_download").select(F.concat_ws("\t", F.coalesce("motivo", F.lit("")), F.coalesce("url", F.lit(""))).alias("value"))
    log.write.text(path)
    return acts.failed_urls(files.failure_log(spark, path)).select("url")


@query("select registro_id, ano, try_cast(ano as integer) as ano_do_caminho from corpus_documentos where ano is not null")
def year_of_path(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat_ws("/", F.lit("dados"), F.lit("pdfs"), F.col("ano").cast("string"), "arquivo_origem")
    return _documents(spark, d).where("ano is not null").select("registro_id", "ano", M.year_of_path(path).alias("ano_do_caminho"))


_WORDS = "palavras as (select registro_id, generate_subscripts(w, 1) - 1 as i, unnest(w) as p from (select registro_id, string_split_regex(trim(titulo), ' +') as w from corpus_documentos where trim(titulo) <> ''))"


def _words(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).where("trim(titulo) <> ''").select("registro_id", F.posexplode(F.split(F.trim("titulo"), " +")).alias("i", "p"))


@query(f"""with {_WORDS}, postas as (select registro_id, i, p, (i // 4) * 10 as y, i % 4 * 60 as x0, i % 4 * 60 + 4 * length(p) as x1 from palavras),
vaos as (select *, x0 - lag(x1) over (partition by registro_id, y order by x0, x1, p) as vao from postas)
select registro_id, cast(y as integer) as y, string_agg(case when vao is null then '' when vao > 15 then '   ' else ' ' end || p, '' order by x0, p) as linha from vaos group by 1, 2""")
def layout_lines(spark: SparkSession, d: str) -> DataFrame:
    """Words of titles set four to a line, 60 points apart."""
    x = F.col("i") % 4 * 60.0
    words = _words(spark, d).select(
        "registro_id", x.alias("x0"), (x + F.length("p") * 4).alias("x1"), (F.floor(F.col("i") / 4) * 10 + F.col("i") % 3).cast("double").alias("y0"),
        F.col("p").alias("word")
    )
    return pages.layout_lines(words, "registro_id")


@query(f"""with {_WORDS}, paginas as (select registro_id, i // 5 as pagina, floor(avg(length(p) * 9 % 101) * 10 + 0.5) / 10 as m from palavras where length(p) % 4 <> 0 group by 1, 2)
select registro_id, floor(avg(m) * 10 + 0.5) / 10 as confianca from paginas group by 1""")
def ocr_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Words of titles with a made-up confidence, five to a page; every fourth length is not recognised (-1)."""
    conf = F.when(F.length("p") % 4 == 0, -1.0).otherwise((F.length("p") * 9 % 101).cast("double"))
    words = _words(spark, d).select("registro_id", F.floor(F.col("i") / 5).alias("pagina"), conf.alias("conf"))
    return pages.ocr_confidence(words, "registro_id")


@query(f"""with {_CHILDREN} select f.registro_id as registro_id, chunk_id, numero_chunk, f.texto as texto from filhos f""")
def stream_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Two loads of documents chunked as they come, the second with all of the first once more."""
    source, target, checkpoint = (folder(spark, f"stream-{x}") for x in ("in", "out", "checkpoint"))
    # the key of a delivery is its file and time; repeats within the table are told apart, so that none of them is taken for another
    docs = _documents(spark, d).withColumn("arquivo_origem", F.concat_ws("#", F.col("registro_id").cast("string"), "arquivo_origem"))
    for part in ("registro_id % 3 = 0", "true"):
        docs.where(part).write.mode("append").parquet(source)
        chunk_stream(spark, source, docs.schema, target, checkpoint).awaitTermination()
    own = lambda c: F.regexp_replace(c, "^[0-9]+#", "").alias(c)
    return spark.read.parquet(target).select("registro_id", own("chunk_id"), "numero_chunk", "texto")


@query("select cast(date_trunc('day', tentado_em) as timestamp) as dia, motivo, count(*) as falhas from falhas_download where tentado_em is not null group by 1, 2")
def stream_failures(spark: SparkSession, d: str) -> DataFrame:
    """Failures counted by day and reason as they come."""
    source = folder(spark, "failures-in")
    rows = table(spark, d, "falhas_download")
    rows.write.parquet(source)
    name = f"falhas_{uuid.uuid4().hex}"
    counts = failures_per_day(spark, source, rows.schema).writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True)
    counts.option("checkpointLocation", folder(spark, "failures-checkpoint")).start().awaitTermination()
    return spark.table(name)
