"""The engine's queries over the test tables, and the same results in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesselex.functions import cleaning as C
from tesselex.functions import metadata as M
from tesselex.functions import pieces as P
from tesselex.functions.words import FEW_STOPWORDS, STOPWORDS, search_words
from tesselex.operators import acts, answers, chunks, pages, search
from tesselex.plans import chunk_sql
from tesselex.plans.lineage import ready, written
from tesselex.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its own name, with its SQL if there is one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, d: f(ready(spark), d)
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- pieces of SQL -------------------------------------------------------------------------------------------------


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g')"


def _stem(x: str) -> str:
    last = f"list_extract(string_split({x}, '/'), -1)"
    return rf"case when regexp_matches({last}, '^.+\.[^.]*$') then regexp_replace({last}, '\.[^.]*$', '') else {last} end"


def _act(x: str) -> str:
    s = rf"regexp_replace(lower({_stem(x)}), '_[0-9]+$', '')"
    p = "'^([a-z]+)(20[0-9]{2})([0-9]+)'"
    kind = f"regexp_extract({s}, {p}, 1)"
    return f"case when {x} is null then null when {kind} = '' then {s} else concat_ws('_', case when regexp_matches({kind}, '^[an].') then {kind}[2:] else {kind} end, regexp_extract({s}, {p}, 3), regexp_extract({s}, {p}, 2)) end"


def _kind(x: str) -> str:
    t = f"lower({_strip(rf'''regexp_replace(coalesce({x}, ''), ':+[\s\x{{a0}}]*$', '')''')})"
    words = " or ".join(f"contains(t, '{w}')" for w in M.ANNEX_WORDS)
    return rf"""(select case
        when regexp_matches(t, 'nota[\s\x{{a0}}]+t[eé]cnica') or regexp_matches(t, '^nt[\s\x{{a0}}.]') or t = 'nt' then 'nota_tecnica'
        when starts_with(t, 'voto') then 'voto'
        when regexp_matches(t, 'texto[\s\x{{a0}}]+i+ntegr') or t in ('integral', 'texto', 'pdf') or starts_with(t, 'texto original') or (starts_with(t, 'texto') and length(t) <= 6) then 'texto_integral'
        when contains(t, 'decis') then 'decisao'
        when regexp_matches(t, '^(anexo|sub?m[oó]dulo|m[oó]dulo($|[^\p{{L}}\p{{N}}_]))') or {words} then 'anexo'
        else 'outro' end from (select {t} as t))"""


def _field(x: str) -> str:
    a = _strip(rf"regexp_replace({x}, '^[A-ZÀ-ÿa-z\s\x{{a0}}]+:[\s\x{{a0}}]*', '')")
    b = _strip(rf"regexp_replace({a}, '[\s\x{{a0}}]+', ' ', 'g')")
    return f"nullif({_strip(rf'''regexp_replace({b}, '(?i)[\s\x{{a0}}]*Imprimir[\s\x{{a0}}]*$', '')''')}, '')"


def _iso(x: str) -> str:
    p = "'([0-9]{2})/([0-9]{2})/([0-9]{4})'"
    return f"case when regexp_matches({x}, {p}) then concat_ws('-', regexp_extract({x}, {p}, 3), regexp_extract({x}, {p}, 2), regexp_extract({x}, {p}, 1)) end"


def _url_file(x: str) -> str:
    return rf"coalesce(nullif(string_split(list_extract(string_split({x}, '/'), -1), '?')[1], ''), 'arquivo')"


def _layer1(x: str) -> str:
    s = r"[\s\x{a0}]"
    for p, to in (
        (rf"(?m)^{s}*Imprimir{s}*$", ""), (rf"(?m)^{s}*Voltar{s}*$", ""), (rf"(?m)^{s}*Topo{s}*$", ""),
        (rf"(?i)P[áa]gina{s}+[0-9]+{s}+de{s}+[0-9]+", ""), (rf"(?i)P[áa]g\.?{s}*[0-9]+($|[^\p{{L}}\p{{N}}_])", r"\1"), (rf"(?i)pg\.{s}*[0-9]+($|[^\p{{L}}\p{{N}}_])", r"\1"),
        (r"(?i)https?://www2?\.aneel\.gov\.br[^\s\x{a0}]*", ""), (r"(?i)www2?\.aneel\.gov\.br[^\s\x{a0}]*", ""),
        (rf"(?i)C[ÓO]PIA{s}+N[ÃA]O{s}+CONTROLADA", ""), (rf"(?i)DOCUMENTO{s}+CONTROLADO", ""),
    ):
        x = f"regexp_replace({x}, '{p}', '{to}', 'g')"
    return x


def _layer2(x: str) -> str:
    x = rf"regexp_replace({x}, '([\p{{L}}\p{{N}}_])-\n([\p{{L}}\p{{N}}_])', '\1\2', 'g')"
    x = rf"regexp_replace(regexp_replace(replace({x}, chr(160), ' '), ' {{2,}}', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"
    return _strip(f"array_to_string(list_transform(string_split({x}, chr(10)), lambda l: {_strip('l')}), chr(10))")


_PIECE = r"[ \t\n\r\f]*(?:[\p{L}\p{N}_]+|[^ \t\n\r\f\p{L}\p{N}_])"


def _pieces(x: str) -> str:
    return f"regexp_extract_all({x}, '{_PIECE}')"


def _words(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in STOPWORDS)
    return rf"list_filter(string_split(regexp_replace(lower(coalesce({x}, '')), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'), ' '), lambda w: length(w) > 2 and not list_contains([{stop}], w))"


_FILES = "files as (select registro_meta_id, ano_json, titulo, ementa, assunto, situacao, publicacao, autor, generate_subscripts(pdfs, 1) - 1 as posicao, unnest(pdfs) as p from metadados_registros)"
_LOOKUP = f"""{_FILES}, lookup as (
    select p.arquivo as arquivo, {_act('p.arquivo')} as ato_id, {_kind('p.tipo')} as tipo_documento, {_field('titulo')} as titulo, {_field('ementa')} as ementa, {_field('assunto')} as assunto,
        {_field('situacao')} as situacao, {_iso('publicacao')} as publicacao, coalesce(nullif(autor, ''), 'ANEEL') as autor,
        coalesce(try_cast(({_iso('publicacao')})[1:4] as integer), ano_json) as ano, ano_json
    from files where coalesce(p.arquivo, '') <> ''
    qualify row_number() over (partition by p.arquivo order by ano_json desc nulls last, registro_meta_id desc, posicao desc) = 1)"""
_PAGES = "linhas as (select registro_id, string_split(texto, chr(10)) as l from corpus_documentos where texto is not null), paginas as (select registro_id, cast(i as integer) as pagina, array_to_string(l[i * 10 + 1:i * 10 + 10], chr(10)) as texto from (select registro_id, l, unnest(range((len(l) - 1) // 10 + 1)) as i from linhas))"
_ENDS = f"list_filter(list_transform(string_split(texto, chr(10)), lambda x: {_strip('x')}), lambda x: x <> '')"
_REPEATED = f"""{_PAGES}, pontas as (select registro_id, pagina, {_ENDS} as e from paginas), total as (select registro_id, count(*) as total from paginas group by 1),
repetidas as (select registro_id, linha, count(*) as paginas from (
        select distinct registro_id, pagina, unnest(list_filter(case when len(e) > 3 then list_concat(e[1:3], e[greatest(len(e) - 2, 1):len(e)]) else e end, lambda x: length(x) > 5)) as linha from pontas)
    join total using (registro_id) group by registro_id, linha, total having count(*) >= greatest(2, total * 0.30))"""


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "corpus_documentos")


def _records(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "metadados_registros")


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks_hierarquicos")


def _questions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "perguntas_benchmark")


# --- acts ----------------------------------------------------------------------------------------------------------


@query(f"with {_FILES} select registro_meta_id, posicao, p.arquivo as arquivo, {_act('p.arquivo')} as ato_id from files")
def ato_id(spark: SparkSession, d: str) -> DataFrame:
    return acts.files(_records(spark, d)).select("registro_meta_id", "posicao", "arquivo", M.act_id(F.col("arquivo")).alias("ato_id"))


@query(f"with {_FILES} select registro_meta_id, posicao, p.tipo as tipo, {_kind('p.tipo')} as tipo_documento from files")
def tipo_normalize(spark: SparkSession, d: str) -> DataFrame:
    return acts.files(_records(spark, d)).select("registro_meta_id", "posicao", "tipo", M.document_type(F.col("tipo")).alias("tipo_documento"))


@query(
    f"select registro_meta_id, {_field('titulo')} as titulo, {_field('ementa')} as ementa, {_field('assunto')} as assunto, {_field('situacao')} as situacao from metadados_registros"
)
def meta_clean(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d).select("registro_meta_id", *[M.clean_field(F.col(c)).alias(c) for c in ("titulo", "ementa", "assunto", "situacao")])


@query(f"select registro_meta_id, publicacao as bruto, {_iso('publicacao')} as publicacao from metadados_registros")
def date_iso(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d).select("registro_meta_id", F.col("publicacao").alias("bruto"), M.iso_date(F.col("publicacao")).alias("publicacao"))


@query(f"with {_LOOKUP} select * from lookup")
def meta_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return acts.lookup(_records(spark, d))


_WITH_METADATA = f"""registro_id, arquivo_origem, coalesce(l.ato_id, {_act('arquivo_origem')}) as ato_id, coalesce(l.tipo_documento, 'outro') as tipo_documento, l.titulo as titulo, l.ementa as ementa, l.assunto as assunto,
    l.situacao as situacao, l.publicacao as publicacao, coalesce(l.autor, 'ANEEL') as autor, l.ano as ano, l.ano_json as ano_json"""


@query(f"with {_LOOKUP} select {_WITH_METADATA} from corpus_documentos d left join lookup l on d.arquivo_origem = l.arquivo")
def file_metadata_join(spark: SparkSession, d: str) -> DataFrame:
    return acts.with_metadata(_documents(spark, d), acts.lookup(_records(spark, d)))


@query(
    f"with {_FILES} select distinct p.arquivo as arquivo, concat_ws('/', cast(ano_json as varchar), p.arquivo) as caminho, {_act('p.arquivo')} as ato_id from files where coalesce(p.arquivo, '') <> '' and p.arquivo not in (select arquivo_origem from corpus_documentos where length(texto) > 0)"
)
def missing_files(spark: SparkSession, d: str) -> DataFrame:
    """The listing is of the files whose text was read."""
    return acts.missing(_records(spark, d), _documents(spark, d).where("length(texto) > 0"), "arquivo_origem")


@query(
    f"with {_FILES} select registro_meta_id, posicao, ano_json, p.url as url, coalesce(nullif(p.arquivo, ''), {_url_file('p.url')}) as nome_arquivo from files where coalesce(p.url, '') <> ''"
)
def download_tasks(spark: SparkSession, d: str) -> DataFrame:
    return acts.download_tasks(_records(spark, d))


_FAILED = r"falhas as (select url, min(falha_id) as falha_id from (select falha_id, list_extract(regexp_extract_all(url, 'https?://[^\s\x{a0}]+'), -1) as url from falhas_download) where url is not null group by 1)"


@query(f"with {_FAILED} select url, falha_id from falhas")
def failure_url_dedup(spark: SparkSession, d: str) -> DataFrame:
    return acts.failed_urls(table(spark, d, "falhas_download"))


@query(f"""with {_FILES}, {_FAILED}, mapa as (select p.url as url, cast(ano_json as varchar) as ano, coalesce(nullif(p.arquivo, ''), {_url_file('p.url')}) as nome from files where coalesce(p.url, '') <> ''
    qualify row_number() over (partition by p.url order by ano_json desc nulls last, registro_meta_id desc, posicao desc) = 1)
select f.url as url, falha_id, coalesce(ano, nullif(regexp_extract(f.url, '(2016|2021|2022)', 1), ''), 'outros') as ano, coalesce(nome, {_url_file('f.url')}) as nome_arquivo from falhas f left join mapa m on f.url = m.url""")
def failure_retry_plan(spark: SparkSession, d: str) -> DataFrame:
    return acts.retry_plan(table(spark, d, "falhas_download"), _records(spark, d))


@query("""select rotulo, count(*) as falhas from (select case when s = 404 then 'HTTP_404_nao_encontrado' when s = 403 then 'HTTP_403_acesso_negado' when s = 429 then 'HTTP_429_rate_limit' when s >= 500 then 'HTTP_' || s || '_erro_servidor'
    when s is not null and s <> 200 then 'HTTP_' || s when contains(m, 'timeout') or contains(m, 'timed out') then 'timeout' when contains(m, 'ssl') or contains(m, 'certificate') then 'erro_ssl' when contains(m, 'connect') then 'erro_conexao' else 'erro_desconhecido' end as rotulo
    from (select try_cast(nullif(regexp_extract(motivo, 'HTTP_([0-9]{3})', 1), '') as integer) as s, lower(coalesce(motivo, '')) as m from falhas_download)) group by 1""")
def failure_classify(spark: SparkSession, d: str) -> DataFrame:
    return acts.failure_counts(table(spark, d, "falhas_download"))


@query(
    rf"with {_FILES} select registro_meta_id, posicao, regexp_replace(regexp_replace({_stem('p.url')}, '^ANEXO_[0-9]{{4}}_', ''), '_dsp[0-9]+$', '') as distribuidora from files"
)
def distributor_name(spark: SparkSession, d: str) -> DataFrame:
    return acts.files(_records(spark, d)).select("registro_meta_id", "posicao", M.distributor(F.col("url")).alias("distribuidora"))


_SHORT = "case tipo_documento when 'texto_integral' then 'ti' when 'voto' then 'vo' when 'nota_tecnica' then 'nt' when 'anexo' then 'an' when 'decisao' then 'de' else 'ou' end"


@query(
    f"select registro_id from corpus_documentos d where not exists (select 1 from chunks_hierarquicos c where c.arquivo_origem = ({_stem('d.arquivo_origem')}) || '_' || {_SHORT.replace('tipo_documento', 'd.tipo_documento')})"
)
def ledger_pending(spark: SparkSession, d: str) -> DataFrame:
    short = chunks._by_type(F.col("tipo_documento"), chunks.SHORT, "ou")
    todo = _documents(spark, d).select("registro_id", F.concat_ws("_", M.file_stem(F.col("arquivo_origem")), short).alias("arquivo_origem"))
    return acts.pending(todo, _chunks(spark, d).select("arquivo_origem"), "arquivo_origem").select("registro_id")


@query(
    "select registro_id, arquivo_origem from corpus_documentos where arquivo_origem in (select p.arquivo from (select unnest(pdfs) as p from metadados_registros) where p.tipo ilike '%voto%')"
)
def file_list_filter(spark: SparkSession, d: str) -> DataFrame:
    wanted = acts.files(_records(spark, d)).where(F.contains(F.lower("tipo"), F.lit("voto"))).select(F.col("arquivo").alias("arquivo_origem"))
    return acts.selected(_documents(spark, d), wanted, "arquivo_origem").select("registro_id", "arquivo_origem")


@query(
    "select ano_json, count(*) as arquivos, count(*) filter (where p.arquivo is null or p.arquivo = '') as sem_nome, count(distinct p.url) as urls from (select ano_json, unnest(pdfs) as p from metadados_registros) group by 1"
)
def download_summary(spark: SparkSession, d: str) -> DataFrame:
    f = acts.files(_records(spark, d))
    return f.groupBy("ano_json").agg(
        F.count("*").alias("arquivos"), F.count_if(F.coalesce("arquivo", F.lit("")) == "").alias("sem_nome"), F.countDistinct("url").alias("urls")
    )


# --- pages and cleaning --------------------------------------------------------------------------------------------


@query(
    f"select registro_id, {_layer2(_layer1('texto'))} as texto, length(texto) - length({_layer1('texto')}) as removidos from corpus_documentos where texto is not null"
)
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    one = C.boilerplate_removed(F.col("texto"))
    return _documents(spark, d).where("texto is not null").select("registro_id", C.normalised(one).alias("texto"), (F.length("texto") - F.length(one)).alias("removidos"))


@query(f"with {_REPEATED} select registro_id, linha, paginas from repetidas")
def repeated_lines(spark: SparkSession, d: str) -> DataFrame:
    return pages.repeated_lines(_documents(spark, d).where("texto is not null"), "registro_id", pages.page_array(F.col("texto")))


@query(f"""with {_REPEATED}, padroes as (select registro_id, list(linha) as p from repetidas group by 1), limpo as (
    select d.registro_id, texto as t0, {_layer1('texto')} as t1, {_layer2(_layer1('texto'))} as t2, coalesce(p, []) as p from corpus_documentos d left join padroes using (registro_id) where texto is not null),
final as (select registro_id, t0, t1, t2, array_to_string(list_filter(string_split(t2, chr(10)), lambda l: not list_contains(p, {_strip('l')})), chr(10)) as texto from limpo)
select registro_id, texto, length(t0) - length(t1) + length(t2) - length(texto) as removidos from final""")
def clean_composite(spark: SparkSession, d: str) -> DataFrame:
    return pages.cleaned(_documents(spark, d).where("texto is not null"), "registro_id", "texto", pages.page_array(F.col("texto")))


_ALPHA = rf"length(regexp_replace(s, '[^\p{{L}}\p{{Nd}}²³¹]', '', 'g')) / length(s)"


@query(
    f"with {_PAGES} select registro_id, pagina, case when length(s) >= 50 then {_ALPHA} < 0.55 else false end as suspeita, cast(case when length(s) >= 50 then floor({_ALPHA} * 1000 + 0.5) else 1000 end as integer) as razao_alfa from (select registro_id, pagina, {_strip('texto')} as s from paginas)"
)
def page_validation(spark: SparkSession, d: str) -> DataFrame:
    return pages.validity(pages.pages_of(_documents(spark, d), "registro_id", "texto"), "registro_id")


_SCORE = """case when c = 0 then 0.0 else floor(greatest(0.0, 1 - least(0.4, case when p = 0 then 0.0 else s * 2.0 / p end) - case when case when p = 0 then 0.0 else floor(c * 10 / p + 0.5) / 10 end < 100 then 0.1 else 0.0 end) * 100 + 0.5) / 100 end"""
_SCORED = "q as (select registro_id, ano, texto, tem_tabela, coalesce(caracteres_extraidos, 0)::double as c, coalesce(paginas, 0) as p, coalesce(len(paginas_suspeitas), 0) as s from corpus_documentos)"


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).withColumn("escore", C.quality(F.col("caracteres_extraidos").cast("double"), F.col("paginas"), F.size("paginas_suspeitas")))


@query(f"with {_SCORED} select registro_id, cast({_SCORE} as double) as escore from q")
def quality_score(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("registro_id", "escore")


@query(f"with {_SCORED} select registro_id from q where {_SCORE} >= 0.7 and texto is not null and length(texto) >= 200")
def quality_filter(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where("escore >= 0.7 and texto is not null and length(texto) >= 200").select("registro_id")


@query(f"""with {_SCORED}, r as (select ano, tem_tabela, c, cast({_SCORE} as double) as e from q)
select ano, count(*) as documentos, count(*) filter (where e >= 1) as plenos, count(*) filter (where e >= 0.5 and e < 1) as parciais, count(*) filter (where e < 0.5) as vazios, count(*) filter (where tem_tabela) as com_tabela, sum(c) as caracteres from r group by ano""")
def parse_summary(spark: SparkSession, d: str) -> DataFrame:
    r, e = _scored(spark, d), F.col("escore")
    return r.groupBy("ano").agg(
        F.count("*").alias("documentos"), F.count_if(e >= 1).alias("plenos"), F.count_if((e >= 0.5) & (e < 1)).alias("parciais"),
        F.count_if(e < 0.5).alias("vazios"), F.count_if("tem_tabela").alias("com_tabela"),
        F.sum(F.coalesce(F.col("caracteres_extraidos"), F.lit(0)).cast("double")).alias("caracteres")
    )


@query("""select ano, count(*) as total, count(*) filter (where coalesce(caracteres_extraidos, 0) > 50) as tem_texto, count(*) filter (where coalesce(caracteres_extraidos, 0) <= 50) as escaneados,
    floor(count(*) filter (where coalesce(caracteres_extraidos, 0) > 50) * 1000.0 / count(*) + 0.5) / 10 as pct_texto from corpus_documentos group by ano""")
def scan_report(spark: SparkSession, d: str) -> DataFrame:
    has = F.coalesce("caracteres_extraidos", F.lit(0)) > 50
    n = F.count_if(has)
    return _documents(spark, d).groupBy("ano").agg(
        F.count("*").alias("total"), n.alias("tem_texto"), F.count_if(~has).alias("escaneados"),
        (F.floor(n * 1000.0 / F.count("*") + 0.5) / 10).alias("pct_texto")
    )


@query(
    """select registro_id, n as ordem, s.pagina as pagina, floor(s.razao_alfa * 1000 + 0.5)::int as razao_alfa from (select registro_id, generate_subscripts(paginas_suspeitas, 1) as n, unnest(paginas_suspeitas) as s from corpus_documentos) where n <= 5"""
)
def suspect_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = _documents(spark, d).select("registro_id", F.posexplode("paginas_suspeitas").alias("i", "s")).where("i < 5")
    return rows.select("registro_id", (F.col("i") + 1).alias("ordem"), "s.pagina", F.floor(F.col("s.razao_alfa") * 1000 + 0.5).cast("int").alias("razao_alfa"))


@query(
    "select tipo_documento, count(*) as documentos, count(*) filter (where ocr) as lidos, floor(avg(confianca_ocr) filter (where ocr and confianca_ocr >= 0) * 10 + 0.5) / 10 as confianca from corpus_documentos group by 1"
)
def ocr_report(spark: SparkSession, d: str) -> DataFrame:
    sure = F.when(F.col("ocr") & (F.col("confianca_ocr") >= 0), F.col("confianca_ocr"))
    return _documents(spark, d).groupBy("tipo_documento").agg(
        F.count("*").alias("documentos"), F.count_if("ocr").alias("lidos"), (F.floor(F.avg(sure) * 10 + 0.5) / 10).alias("confianca")
    )


@query(
    r"select registro_id, case when regexp_matches(texto, '[\x{fffd}\x{25a1}\x{0}]|[ÂÃ][\x{80}-\x{bf}]|â€') then 'latin-1' else 'utf-8' end as codificacao from corpus_documentos where texto is not null"
)
def encoding_tag(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).where("texto is not null").select("registro_id", C.encoding_tag(F.col("texto")).alias("codificacao"))


@query(
    f"with {_SCORED} select q.registro_id as registro_id, case when coalesce(d.ocr, false) then 0.0::double else cast({_SCORE} as double) end as escore from q join (select registro_id, ocr from corpus_documentos) d on q.registro_id = d.registro_id"
)
def quality_score_read(spark: SparkSession, d: str) -> DataFrame:
    q = C.quality_read(F.col("caracteres_extraidos").cast("double"), F.col("paginas"), F.size("paginas_suspeitas"), F.col("ocr"))
    return _documents(spark, d).select("registro_id", q.alias("escore"))


_HTML = "'<html><head><meta charset=\"utf-8\"><style>p { }</style><script>var a = 1;</script></head><body><nav>Menu</nav><header>Topo do sitio</header><p>' || replace(replace(replace(replace(replace(replace(texto, '&', '&amp;'), 'ç', '&ccedil;'), 'ã', '&atilde;'), 'é', '&#233;'), 'º', '&#xBA;'), chr(10) || chr(10), '</p><p>') || '</p><!-- fim --><footer>Rodape</footer></body></html>'"


def _html_sql() -> str:
    x = rf"regexp_replace({_HTML}, '(?s)<!--.*?-->', '', 'g')"
    for tag in ("script", "style", "nav", "header", "footer"):
        x = rf"regexp_replace({x}, '(?is)<{tag}(?:[\s/][^>]*)?>.*?</{tag}[\s]*>', chr(10), 'g')"
    x = rf"regexp_replace({x}, '<[^>]*>', chr(10), 'g')"
    for a, b in (("&ccedil;", "ç"), ("&atilde;", "ã"), ("&#233;", "é"), ("&#xBA;", "º"), ("&amp;", "&")):
        x = f"replace({x}, '{a}', '{b}')"
    return f"select registro_id, {_layer2(_layer1(x))} as texto from corpus_documentos where texto is not null"


@query(_html_sql())
def html_text(spark: SparkSession, d: str) -> DataFrame:
    """Texts wrapped into pages with entities for some letters, as the tables hold none."""
    t = F.col("texto")
    for sign, entity in (("&", "&amp;"), ("ç", "&ccedil;"), ("ã", "&atilde;"), ("é", "&#233;"), ("º", "&#xBA;"), ("\n\n", "</p><p>")):
        t = F.replace(t, F.lit(sign), F.lit(entity))
    page = F.concat(
        F.lit('<html><head><meta charset="utf-8"><style>p { }</style><script>var a = 1;</script></head><body><nav>Menu</nav><header>Topo do sitio</header><p>'),
        t,
        F.lit("</p><!-- fim --><footer>Rodape</footer></body></html>"),
    )
    return _documents(spark, d).where("texto is not null").select("registro_id", C.html_text(page).alias("texto"))


# layout: Markdown tables of the texts stretched back into columns three spaces apart
_STRETCHED = r"regexp_replace(regexp_replace(texto, '(?m)^\|[-| ]+\|$\n?', '', 'g'), '\s*\|\s?', '   ', 'g')"
_LAYOUT_LINES = f"linhas as (select registro_id, generate_subscripts(string_split({_STRETCHED}, chr(10)), 1) - 1 as linha_no, unnest(string_split({_STRETCHED}, chr(10))) as linha from corpus_documentos where texto is not null)"
_IS_TABLE = f"(length({_strip('linha')}) >= 20 and len(list_filter(string_split_regex({_strip('linha')}, ' {{3,}}'), lambda c: length({_strip('c')}) >= 3)) >= 3)"


def _stretch(text: str) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"(?md)^\|[-| ]+\|$\n?", ""), r"[ \t\n\f\r]*\|[ \t\n\f\r]?", "   ")


def _stretched(spark: SparkSession, d: str) -> DataFrame:
    return pages.lines_of(_documents(spark, d).where("texto is not null"), "registro_id", _stretch("texto"))


@query(rf"with {_LAYOUT_LINES} select registro_id, linha_no, {_IS_TABLE} as tabela from linhas")
def layout_table_lines(spark: SparkSession, d: str) -> DataFrame:
    return _stretched(spark, d).select("registro_id", "linha_no", pages.is_table_line(F.col("linha")).alias("tabela"))


_CELLS = f"list_transform(linhas, lambda x: list_filter(list_transform(string_split_regex({_strip('x')}, ' {{3,}}'), lambda c: {_strip('c')}), lambda c: c <> ''))"
_ROW = "'| ' || array_to_string(list_concat(c, list_transform(range(w - len(c)), lambda i: '')), ' | ') || ' |'"


def _layout_sql(source: str) -> str:
    """prontas (registro_id, pagina, tabelas, chars_tabela, texto, removidos) of a source of (registro_id, pagina, texto),
    with the lines in `padroes` (registro_id, p) left out.
    """
    head = "[rows[1], '| ' || array_to_string(list_transform(range(w), lambda i: '---'), ' | ') || ' |']"
    width = "(select list_max(list_transform(cs, lambda c: len(c))) as w)"
    key = "registro_id, pagina"
    return rf"""
lx as (select {key}, generate_subscripts(string_split(texto, chr(10)), 1) - 1 as linha_no, unnest(string_split(texto, chr(10))) as linha from {source}),
f as (select *, {_IS_TABLE} as tabela from lx),
g as (select *, sum(nova) over (partition by {key} order by linha_no) as ordem
    from (select *, case when tabela is distinct from lag(tabela) over (partition by {key} order by linha_no) then 1 else 0 end as nova from f)),
r as (select {key}, ordem, any_value(tabela) as tabela, list(linha order by linha_no) as linhas from g group by 1, 2, 3),
m as (select *, tabela and len(linhas) >= 4 as mesa from r),
s as (select *, sum(case when mesa or coalesce(antes, true) or tabela then 1 else 0 end) over (partition by {key} order by ordem) as parte
    from (select *, lag(mesa) over (partition by {key} order by ordem) as antes from m)),
q as (select {key}, parte, bool_or(mesa) as mesa, flatten(list(linhas order by ordem)) as linhas from s group by 1, 2, 3),
c as (select *, {_CELLS} as cs, array_to_string(linhas, chr(10)) as t0 from q),
u as (select *, {_layer1("t0")} as t1, {_layer2(_layer1("t0"))} as t2 from c),
v as (select u.*, array_to_string(list_filter(string_split(t2, chr(10)), lambda l: not list_contains(coalesce(p, []), {_strip('l')})), chr(10)) as t3 from u left join padroes using (registro_id)),
t as (select {key}, parte, mesa, case when mesa then 0 else length(t0) - length(t1) + length(t2) - length(t3) end as removidos, case when mesa
    then (select array_to_string(list_concat({head}, rows[2:]), chr(10)) from (select w, list_transform(cs, lambda c: {_ROW}) as rows from {width})) else t3 end as t from v),
prontas as (select {key}, cast(count(*) filter (where mesa) as bigint) as tabelas, cast(sum(case when mesa then length(t) else 0 end) as bigint) as chars_tabela,
    coalesce(string_agg(t, chr(10) || chr(10) order by parte) filter (where mesa or {_strip('t')} <> ''), '') as texto, cast(sum(removidos) as bigint) as removidos from t group by 1, 2)"""


_PATTERNS = "padroes as (select registro_id, list(linha) as p from repetidas group by 1)"


@query(f"""with {_REPEATED}, {_PATTERNS}, esticados as (select registro_id, 0 as pagina, {_STRETCHED} as texto from corpus_documentos where texto is not null), {_layout_sql('esticados')}
select registro_id, tabelas, chars_tabela, texto, removidos from prontas""")
def layout_reconstruct(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d).where("texto is not null")
    return pages.laid_out(docs, "registro_id", F.split(_stretch("texto"), "\n"), pages.patterns_of(pages.page_array(F.col("texto"))))


_STRETCHED_PAGES = _REPEATED.replace("string_split(texto, chr(10)) as l from corpus_documentos", f"string_split({_STRETCHED}, chr(10)) as l from corpus_documentos")


@query(f"""with {_STRETCHED_PAGES}, {_PATTERNS}, {_layout_sql('paginas')},
somas as (select registro_id, count(*) as paginas, cast(sum(tabelas) as bigint) as tabelas, cast(sum(chars_tabela) as bigint) as chars_tabela, cast(sum(removidos) as bigint) as removidos,
    coalesce(string_agg(texto, chr(10) || chr(10) order by pagina) filter (where {_strip('texto')} <> ''), '') as texto from prontas group by 1),
fracas as (select registro_id, count(*) filter (where length(s) >= 50 and {_ALPHA} < 0.55) as suspeitas from (select registro_id, {_strip('texto')} as s from paginas) group by 1)
select registro_id, paginas, length(texto) as caracteres, suspeitas, tabelas, chars_tabela, removidos, texto from somas join fracas using (registro_id)""")
def document_rollup(spark: SparkSession, d: str) -> DataFrame:
    return pages.rollup(_documents(spark, d).where("texto is not null"), "registro_id", pages.page_array(_stretch("texto")))


_BLOCKS = chunk_sql.BLOCKS


@query(f"with {_BLOCKS} select * from blocos")
def table_blocks(spark: SparkSession, d: str) -> DataFrame:
    return pages.table_blocks(_documents(spark, d), "registro_id", "texto")


# --- chunks --------------------------------------------------------------------------------------------------------


def _windows_sql(size: int, overlap: int, where: str) -> str:
    step = size - overlap
    return f"""p as (select registro_id, {_pieces('texto')} as p from corpus_documentos where texto is not null and {where}),
w as (select registro_id, p, unnest(range(case when len(p) <= {size} then 1 else 1 + cast(ceil((len(p) - {size}) / {step}.0) as bigint) end)) as i from p where len(p) > 0),
janelas as (select registro_id, cast(i as integer) as parte, array_to_string(p[i * {step} + 1:i * {step} + {size}], '') as texto from w)"""


@query(f"select row_id, len({_pieces('texto')}) as tokens from chunks_hierarquicos")
def token_count(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).select("row_id", P.count(F.col("texto")).alias("tokens"))


@query(f"with {_windows_sql(256, 0, 'true')} select * from janelas")
def chunk_fixed(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).where("texto is not null").select("registro_id", F.posexplode(P.windows(F.col("texto"), chunks.CHILD)).alias("parte", "texto"))


@query(f"with {_windows_sql(256, 50, '''tipo_documento in ('voto', 'outro')''')} select * from janelas")
def chunk_overlap(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).where("tipo_documento in ('voto', 'outro') and texto is not null").select(
        "registro_id", F.posexplode(P.windows(F.col("texto"), chunks.CHILD, chunks.OVERLAP)).alias("parte", "texto")
    )


_SEGMENTS = rf"""s as (select registro_id, list_filter(list_transform(string_split(regexp_replace(texto, '(?im)^({chunks.ARTICLE_BEGINS.replace('[0-9]', '[0-9]').replace(' ', '')})', chr(1) || '\1', 'g'), chr(1)), lambda x: {_strip('x')}), lambda x: x <> '') as s from corpus_documentos where texto is not null and tipo_documento = 'texto_integral')"""


def _names_sql(x: str) -> str:
    return f"{_strip(rf'''regexp_extract({x}, '(?i)^({chunks.ARTICLE_NAME})', 1)''')}"


@query(
    rf"with {_SEGMENTS}, u as (select registro_id, unnest(range(len(s))) as i, s from s) select registro_id, cast(i as integer) as parte, {_names_sql('s[i + 1]')} as contexto, s[i + 1] as texto from u".replace("[\\s ]", "[\\s\\x{a0}]")
)
def structural_split(spark: SparkSession, d: str) -> DataFrame:
    parts = chunks.segments(F.col("texto"), chunks.ARTICLE_BEGINS)
    rows = _documents(spark, d).where("tipo_documento = 'texto_integral' and texto is not null").select(
        "registro_id", F.posexplode(chunks.named(parts, chunks.ARTICLE_NAME)).alias("parte", "x")
    )
    return rows.select("registro_id", "parte", "x.contexto", "x.texto")


_FIT = rf"""paras as (select registro_id, i, s[i + 1] as seg, list_transform(list_filter(list_transform(string_split(s[i + 1], chr(10)), lambda x: {_strip('x')}), lambda x: x <> ''), lambda x: {{'p': x, 'n': len({_pieces('x')})}}) as ps from (select registro_id, s, unnest(range(len(s))) as i from s where len(s) > 1)),
fold as (select registro_id, i, seg, list_reduce(list_transform(ps, lambda x: {{'out': cast([] as varchar[]), 'cur': x.p, 'n': cast(x.n as bigint)}}), lambda a, x: case when a.n + x.n <= 256 then {{'out': a.out, 'cur': case when a.cur = '' then x.cur else a.cur || chr(10) || x.cur end, 'n': a.n + x.n}}
    else {{'out': list_concat(list_concat(a.out, case when a.cur = '' then cast([] as varchar[]) else [a.cur] end), list_transform(range(case when x.n <= 256 then 1 else 1 + cast(ceil((x.n - 256) / 256.0) as bigint) end), lambda k: case when x.n <= 256 then x.cur else array_to_string({_pieces('x.cur')}[k * 256 + 1:k * 256 + 256], '') end)), 'cur': '', 'n': cast(0 as bigint)}} end,
    {{'out': cast([] as varchar[]), 'cur': '', 'n': cast(0 as bigint)}}) as r from paras)"""


@query(
    rf"with {_SEGMENTS}, {_FIT}, f as (select registro_id, i, case when len({_pieces('seg')}) <= 256 then [seg] else list_concat(r.out, case when r.cur = '' then cast([] as varchar[]) else [r.cur] end) end as t from fold), g as (select registro_id, flatten(list(t order by i)) as t from f group by 1) select registro_id, cast(generate_subscripts(t, 1) - 1 as integer) as parte, unnest(t) as texto from g".replace("[\\s ]", "[\\s\\x{a0}]")
)
def chunk_fit_segments(spark: SparkSession, d: str) -> DataFrame:
    parts = chunks.segments(F.col("texto"), chunks.ARTICLE_BEGINS)
    rows = _documents(spark, d).where("tipo_documento = 'texto_integral' and texto is not null").select("registro_id", parts.alias("s")).where("size(s) > 1")
    return rows.select("registro_id", F.posexplode(F.flatten(F.transform("s", lambda x: chunks.fitted(x)))).alias("parte", "texto"))


@query(rf"with {_BLOCKS}, {chunk_sql.TABLES} select registro_id, ordem, cast(generate_subscripts(p, 1) - 1 as integer) as parte, unnest(p) as texto from cortadas")
def chunk_table_rows(spark: SparkSession, d: str) -> DataFrame:
    return table_blocks(spark, d).where("tabela").select("registro_id", "ordem", F.posexplode(chunks.table_rows(F.col("bloco"))).alias("parte", "texto"))


_CHILDREN = chunk_sql.children(chunks.CAPS, chunks.OTHER_CAP, _stem("d.arquivo_origem"))
#: Caps that most texts of the test tables exceed, as hardly any reaches the usual ones.
_LOW_CAPS = dict.fromkeys(chunks.CAPS, 2)


@query(f"with {_CHILDREN} select * exclude (gerados, limite, k) from filhos")
def chunk_documents(spark: SparkSession, d: str) -> DataFrame:
    return chunks.children(_documents(spark, d))


@query(f"with {_CHILDREN} select registro_id, numero_chunk, total_chunks, posicao_relativa, chunk_id, chunk_anterior_id, chunk_proximo_id from filhos")
def chunk_links(spark: SparkSession, d: str) -> DataFrame:
    return chunks.children(_documents(spark, d)).select(
        "registro_id", "numero_chunk", "total_chunks", "posicao_relativa", "chunk_id", "chunk_anterior_id", "chunk_proximo_id"
    )


@query(f"with {_CHILDREN} select registro_id, numero_chunk, texto_pai from filhos")
def chunk_parents(spark: SparkSession, d: str) -> DataFrame:
    return chunks.children(_documents(spark, d)).select("registro_id", "numero_chunk", "texto_pai")


def _truncated_sql(caps: dict[str, int], other: int) -> str:
    return f"""with {chunk_sql.children(caps, other, _stem("d.arquivo_origem"))}
    select f.registro_id as registro_id, k as tipo_documento, gerados as chunks_gerados, limite as chunks_mantidos, len({_pieces('d.texto')}) as tokens_totais from filhos f join corpus_documentos d on d.registro_id = f.registro_id where numero_chunk = 1 and gerados > limite"""


@query(_truncated_sql(chunks.CAPS, chunks.OTHER_CAP))
def chunk_caps_truncation_log(spark: SparkSession, d: str) -> DataFrame:
    return chunks.truncated(_documents(spark, d))


@query(_truncated_sql(_LOW_CAPS, chunks.OTHER_CAP))
def chunk_low_caps_truncation_log(spark: SparkSession, d: str) -> DataFrame:
    """With caps that the test tables do exceed."""
    return chunks.truncated(_documents(spark, d), _LOW_CAPS)


@query(
    f"with {chunk_sql.children(_LOW_CAPS, chunks.OTHER_CAP, _stem('d.arquivo_origem'))} select registro_id, chunk_id, total_chunks, texto, texto_pai, aviso from filhos"
)
def chunk_low_caps(spark: SparkSession, d: str) -> DataFrame:
    return chunks.children(_documents(spark, d), _LOW_CAPS).select("registro_id", "chunk_id", "total_chunks", "texto", "texto_pai", "aviso")


@query("select tipo_documento, count(*) as chunks, floor(count(*) * 1000.0 / sum(count(*)) over () + 0.5) / 10 as pct from chunks_hierarquicos group by 1")
def chunk_type_distribution(spark: SparkSession, d: str) -> DataFrame:
    rows = _chunks(spark, d)
    total = rows.agg(F.count("*").alias("total"))
    return rows.groupBy("tipo_documento").agg(F.count("*").alias("chunks")).crossJoin(F.broadcast(total)).select("tipo_documento", "chunks", (F.floor(F.col("chunks") * 1000.0 / F.col("total") + 0.5) / 10).alias("pct"))  # one row


@query("""with n as (select arquivo_origem, any_value(tipo_documento) as t, count(*) as n from (select arquivo_origem, max(tipo_documento) over (partition by arquivo_origem) as tipo_documento from chunks_hierarquicos) group by 1)
select t as tipo_documento, count(*) as documentos, sum(n)::bigint as chunks, floor(avg(n) * 10 + 0.5) / 10 as media, arg_max(arquivo_origem, {'n': n, 'k': 0}) filter (where false) as ignorado, max(n) as maior, min(n) as menor from n group by 1""".replace("arg_max(arquivo_origem, {'n': n, 'k': 0}) filter (where false) as ignorado, ", "first(arquivo_origem order by n desc, arquivo_origem) as doc_maior, first(arquivo_origem order by n, arquivo_origem) as doc_menor, "))
def chunk_stats_extremes(spark: SparkSession, d: str) -> DataFrame:
    n = _chunks(spark, d).groupBy("arquivo_origem").agg(F.max("tipo_documento").alias("tipo_documento"), F.count("*").alias("n"))
    by = n.groupBy("tipo_documento").agg(
        F.count("*").alias("documentos"), F.sum("n").alias("chunks"), (F.floor(F.avg("n") * 10 + 0.5) / 10).alias("media"),
        F.min(F.struct(-F.col("n"), "arquivo_origem")).alias("a"), F.min(F.struct("n", "arquivo_origem")).alias("b")
    )
    return by.select(
        "tipo_documento", "documentos", "chunks", "media", F.col("a.arquivo_origem").alias("doc_maior"), F.col("b.arquivo_origem").alias("doc_menor"),
        (-F.col("a.col1")).alias("maior"), F.col("b.n").alias("menor")
    )


@query(f"""select tipo_documento, count(*) as n, floor(avg(t) * 10 + 0.5) / 10 as media, floor(coalesce(stddev_samp(t), 0) * 10 + 0.5) / 10 as desvio, min(t) as minimo, quantile_cont(t, 0.25) as q25, quantile_cont(t, 0.5) as q50, quantile_cont(t, 0.75) as q75, max(t) as maximo
    from (select tipo_documento, len({_pieces('texto')}) as t from chunks_hierarquicos) group by 1""")
def chunk_describe(spark: SparkSession, d: str) -> DataFrame:
    t = _chunks(spark, d).select("tipo_documento", P.count(F.col("texto")).alias("t"))
    r = lambda c: F.floor(c * 10 + 0.5) / 10
    q = lambda p: F.percentile("t", F.lit(p))
    return t.groupBy("tipo_documento").agg(
        F.count("*").alias("n"), r(F.avg("t")).alias("media"), r(F.coalesce(F.stddev_samp("t"), F.lit(0.0))).alias("desvio"),
        F.min("t").alias("minimo"), q(0.25).alias("q25"), q(0.5).alias("q50"), q(0.75).alias("q75"), F.max("t").alias("maximo")
    )


@query("""with um as (select * from chunks_hierarquicos qualify row_number() over (partition by chunk_id order by row_id) = 1)
select row_number() over (order by chunk_id nulls first) - 1 as linha, row_id, chunk_id, regexp_replace(chunk_id, '_c[0-9]+$', '') as arquivo_origem, coalesce(ano, 0) as ano, coalesce(tipo_documento, '') as tipo_documento from um""")
def chunk_index_rows(spark: SparkSession, d: str) -> DataFrame:
    return chunks.index_rows(_chunks(spark, d))


@query(
    "select row_id, case when coalesce(contexto_juridico, '') <> '' then 'passage: [' || contexto_juridico || '] ' || texto else 'passage: ' || texto end as passagem from chunks_hierarquicos"
)
def passage_build(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).select("row_id", chunks.passage(F.col("contexto_juridico"), F.col("texto")).alias("passagem"))


def _context(titulo: str, ato: str, texto: str) -> str:
    a = rf"regexp_extract({texto}, '(?:^|[^\p{{L}}\p{{N}}_])Art\.[\s\x{{a0}}]*([0-9]+)', 1)"
    p = rf"regexp_extract({texto}, '§[\s\x{{a0}}]*([0-9]+)', 1)"
    single = f"contains({texto}, 'Parágrafo único') or contains({texto}, 'parágrafo único')"
    both = f"concat_ws(', ', case when {a} <> '' then 'Art. ' || {a} end, case when {p} <> '' then '§' || {p} when {single} then 'Parágrafo único' end)"
    base = f"coalesce(nullif({titulo}, ''), {ato})"
    return f"case when {both} = '' then {base} else concat_ws(' - ', {base}, {both}) end"


@query(f"select row_id, {_context('titulo', 'ato_id', 'texto')} as contexto from chunks_hierarquicos")
def legal_context(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d).select("row_id", chunks.legal_context(F.col("titulo"), F.col("ato_id"), F.col("texto")).alias("contexto"))


@query(chunk_sql.packed())
def chunk_packed(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).where("texto is not null").select("registro_id", F.posexplode(chunks.packed(F.col("texto"))).alias("parte", "texto"))


@query(f"""select tipo_documento, registro_id, arquivo_origem from corpus_documentos where tipo_documento in ('texto_integral', 'voto', 'nota_tecnica', 'anexo', 'decisao') and len({_pieces('texto')}) >= 80
    qualify row_number() over (partition by tipo_documento order by coalesce(ano, 0), arquivo_origem, registro_id) = 1""")
def exemplar_per_type(spark: SparkSession, d: str) -> DataFrame:
    return chunks.exemplars(_documents(spark, d))


# --- search and answers --------------------------------------------------------------------------------------------

_TERMS = f"""termos as (select row_id, {_words('texto')} as w from chunks_hierarquicos),
dfs as (select termo, count(*) as df from (select unnest(list_distinct(w)) as termo from termos) group by 1),
cru as (select termo, df, ln((select count(*) from termos) - df + 0.5) - ln(df + 0.5) as raw from dfs),
idfs as (select termo, df, case when raw < 0 then 0.25 * (select avg(raw) from cru) else raw end as idf from cru)"""
_BM25 = f"""{_TERMS}, perguntas as (select pergunta_id, termo, count(*) as vezes from (select pergunta_id, unnest({_words('pergunta')}) as termo from perguntas_benchmark) group by 1, 2),
postos as (select row_id, dl, termo, count(*) as tf from (select row_id, len(w) as dl, unnest(w) as termo from termos) group by 1, 2, 3),
esparso as (select pergunta_id, row_id, escore, row_number() over (partition by pergunta_id order by escore desc, row_id) - 1 as posicao from (
    select pergunta_id, row_id, floor(sum(idf * vezes * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / (select avg(len(w)) from termos)))) * 1000000 + 0.5) / 1000000 as escore
    from postos join perguntas using (termo) join idfs using (termo) group by 1, 2) where escore > 0 qualify posicao < 20)"""


def _embed_sql(name: str, source: str, key: str, text: str) -> str:
    return f"""{name}_t as (select {key}, t, ('0x' || md5(t)[1:2])::integer % 64 as dim, case when ('0x' || md5(t)[3:3])::integer < 8 then 1.0 else -1.0 end as s from (select {key}, unnest({_words(text)}) as t from {source})),
{name}_d as (select {key}, dim, sum(s)::double as x from {name}_t group by 1, 2),
{name}_n as (select {key}, sqrt(sum(x * x)) as n from {name}_d group by 1),
{name} as (select {key}, dim, case when n > 0 then x / n else 0.0 end as x from {name}_d join {name}_n using ({key}))"""


_DENSE = f"""{_embed_sql('vc', 'chunks_hierarquicos', 'row_id', 'texto')}, {_embed_sql('vq', 'perguntas_benchmark', 'pergunta_id', 'pergunta')},
pares as (select pergunta_id, row_id, sum(vc.x * vq.x) as e from vc join vq using (dim) group by 1, 2),
denso as (select p.pergunta_id, c.row_id, floor(coalesce(e, 0.0) * 1000000 + 0.5) / 1000000 as escore, row_number() over (partition by p.pergunta_id order by floor(coalesce(e, 0.0) * 1000000 + 0.5) / 1000000 desc, c.row_id) - 1 as posicao
    from perguntas_benchmark p cross join (select row_id from chunks_hierarquicos) c left join pares using (pergunta_id, row_id) qualify posicao < 20)"""
_FUSED = """fundido as (select pergunta_id, row_id, escore, row_number() over (partition by pergunta_id order by escore desc, d nulls last, s nulls last) - 1 as posicao from (
    select coalesce(a.pergunta_id, b.pergunta_id) as pergunta_id, coalesce(a.row_id, b.row_id) as row_id, a.posicao as d, b.posicao as s,
    floor((coalesce(0.6 / (60 + a.posicao + 1), 0.0)::double + coalesce(0.4 / (60 + b.posicao + 1), 0.0)::double) * 1e9 + 0.5) / 1e9 as escore
    from denso a full outer join esparso b on a.pergunta_id = b.pergunta_id and a.row_id = b.row_id) qualify posicao < 20)"""
_RERANKED = f"""ordenado as (select pergunta_id, row_id, ato_id, tipo_documento, bruto, escore, row_number() over (partition by pergunta_id order by escore desc, antes) - 1 as posicao from (
    select pergunta_id, row_id, ato_id, tipo_documento, antes, floor(r * 1000000 + 0.5) / 1000000 as bruto, floor(r * b * 1000000 + 0.5) / 1000000 as escore from (
        select f.pergunta_id, row_id, ato_id, tipo_documento, f.posicao as antes, case when len(qw) = 0 then 0.0 else len(list_intersect(qw, {_words('texto')}))::double / len(qw) end as r,
            case tipo_documento when 'texto_integral' then 1.20::double when 'nota_tecnica' then 1.05::double when 'anexo' then 1.05::double when 'voto' then 0.90::double when 'outro' then 0.85::double else 1.0::double end as b
        from fundido f join chunks_hierarquicos using (row_id) join (select pergunta_id, list_distinct({_words('pergunta')}) as qw from perguntas_benchmark) q on f.pergunta_id = q.pergunta_id)) qualify posicao < 5)"""


def _expanded_sql(reserve: bool) -> str:
    rest = "where posicao >= 1000 or posicao < 5 - x" if reserve else ""
    return f"""atos as (select pergunta_id, ato_id, min(posicao) as de from ordenado where posicao < 3 and tipo_documento in ('voto', 'nota_tecnica') and coalesce(ato_id, '') <> '' group by 1, 2),
primeiro as (select ato_id, min(row_id) as row_id from chunks_hierarquicos where tipo_documento = 'texto_integral' group by 1),
extra as (select atos.pergunta_id, primeiro.row_id, ato_id, 'texto_integral' as tipo_documento, 0.0::double as bruto, 0.0::double as escore, de + 1000 as posicao from atos join primeiro using (ato_id)
    where not exists (select 1 from ordenado o where o.pergunta_id = atos.pergunta_id and o.row_id = primeiro.row_id)),
ambos as (select *, count(*) filter (where posicao >= 1000) over (partition by pergunta_id) as x from (select * from ordenado union all select * from extra)),
ampliado as (select pergunta_id, row_id, ato_id, tipo_documento, bruto, escore, row_number() over (partition by pergunta_id order by posicao) - 1 as posicao from ambos {rest} qualify row_number() over (partition by pergunta_id order by posicao) <= 5)"""


_BLOCKS_TEXT = """blocos as (select pergunta_id, posicao, concat_ws(chr(10), '━━━ DOCUMENTO ' || (posicao + 1) || ' ━━━', 'Título:      ' || coalesce(titulo, ''), 'Tipo:        ' || coalesce(upper(c.tipo_documento), ''), 'Publicação:  ' || coalesce(publicacao, ''),
    'Situação:    ' || coalesce(situacao, ''), 'Localização: ' || coalesce(contexto_juridico, ''), '', 'TRECHO:', coalesce(nullif(texto_pai, ''), texto, ''), '') as bloco from ampliado a join chunks_hierarquicos c using (row_id))"""
_HYBRID = f"{_BM25}, {_DENSE}, {_FUSED}, {_RERANKED}, {_expanded_sql(False)}"


@query(f"with {_TERMS} select termo, df, floor(idf * 1000000 + 0.5) / 1000000 as idf from idfs")
def bm25_term_stats(spark: SparkSession, d: str) -> DataFrame:
    return search.term_stats(search.analysed(_chunks(spark, d), "row_id", "texto")).select("termo", "df", search.rounded(F.col("idf")).alias("idf"))


@query(f"with {_BM25} select pergunta_id, row_id, escore, posicao from esparso")
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    return search.bm25(search.words_of(_chunks(spark, d)), "row_id", _questions(spark, d), "pergunta")


def _vector_queries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("pergunta_id"), F.col("embedding").alias("vetor"))


def _knn_sql(where: str) -> str:
    return f"""select pergunta_id, vec_id, escore, row_number() over (partition by pergunta_id order by escore desc, vec_id) - 1 as posicao from (select q.vec_id as pergunta_id, e.vec_id, floor(list_dot_product(q.embedding::double[], e.embedding::double[]) * 1000000 + 0.5) / 1000000 as escore
    from embeddings q cross join embeddings e where q.vec_id % 20 = 0 {where}) qualify posicao < 20"""


@query(_knn_sql(""))
def dense_topk(spark: SparkSession, d: str) -> DataFrame:
    """Every vector whose id is divisible by 20 against all."""
    return search.nearest(table(spark, d, "embeddings"), "vec_id", "embedding", _vector_queries(spark, d))


@query(_knn_sql("and e.label in (1, 3)"))
def dense_topk_filtered(spark: SparkSession, d: str) -> DataFrame:
    return search.nearest(table(spark, d, "embeddings").where("label in (1, 3)"), "vec_id", "embedding", _vector_queries(spark, d))


@query(f"with {_DENSE} select pergunta_id, row_id, escore, posicao from denso")
def dense_questions(spark: SparkSession, d: str) -> DataFrame:
    return search.dense_questions(search.analysed(_chunks(spark, d), "row_id", "texto", "tipo_documento"), _questions(spark, d))


@query(f"with {_BM25}, {_DENSE}, {_FUSED} select pergunta_id, row_id, escore, posicao from fundido")
def rrf_fuse(spark: SparkSession, d: str) -> DataFrame:
    return search.fused(search.words_of(_chunks(spark, d)), _questions(spark, d))


@query(f"with {_BM25}, {_DENSE}, {_FUSED}, {_RERANKED} select * from ordenado")
def rerank_boost(spark: SparkSession, d: str) -> DataFrame:
    c, q = _chunks(spark, d), _questions(spark, d)
    return search.rerank(rrf_fuse(spark, d), c, "row_id", q)


@query(f"with {_BM25}, {_DENSE}, {_FUSED}, {_RERANKED}, {_expanded_sql(True)} select * from ampliado")
def expand_by_ato(spark: SparkSession, d: str) -> DataFrame:
    return search.hybrid(_chunks(spark, d), _questions(spark, d), mode="reserve")


@query(f"with {_HYBRID} select * from ampliado")
def hybrid_retrieve(spark: SparkSession, d: str) -> DataFrame:
    return search.hybrid(_chunks(spark, d), _questions(spark, d))


@query(
    f"with {_BM25}, {_DENSE}, {_FUSED} select pergunta_id, row_id, f.posicao, ato_id, arquivo_origem from fundido f join chunks_hierarquicos using (row_id) qualify row_number() over (partition by pergunta_id, ato_id, arquivo_origem order by f.posicao) <= 2"
)
def dedup_max_per_doc(spark: SparkSession, d: str) -> DataFrame:
    fused = rrf_fuse(spark, d).select("pergunta_id", "row_id", "posicao")
    rows = _chunks(spark, d).select("row_id", "ato_id", "arquivo_origem").join(search.bounded(fused), "row_id")
    return search.at_most_per_document(rows.select("pergunta_id", "row_id", "posicao", "ato_id", "arquivo_origem"), ["ato_id", "arquivo_origem"])


@query(f"with {_HYBRID}, {_BLOCKS_TEXT} select pergunta_id, posicao, bloco from blocos")
def context_blocks(spark: SparkSession, d: str) -> DataFrame:
    return answers.context_blocks(hybrid_retrieve(spark, d), _chunks(spark, d), "row_id")


@query(f"""with {_HYBRID}, {_BLOCKS_TEXT}, ctx as (select pergunta_id, string_agg(bloco, chr(10) order by posicao) as c from blocos group by 1)
select p.pergunta_id as pergunta_id, 0 as ordem, 'system' as role, '{answers.SYSTEM}' as content from perguntas_benchmark p
union all select p.pergunta_id, 1, 'user', case when c is null then '{answers.NOTHING_FOUND}' else 'DOCUMENTOS RECUPERADOS:' || chr(10) || chr(10) || c || chr(10) || chr(10) || repeat('═', 50) || chr(10) || 'PERGUNTA: ' || coalesce(pergunta, '') || chr(10) || chr(10) || 'Responda com base exclusivamente nos documentos acima, citando as fontes.' end
from perguntas_benchmark p left join ctx on p.pergunta_id = ctx.pergunta_id""")
def prompt_messages(spark: SparkSession, d: str) -> DataFrame:
    both = answers.messages(context_blocks(spark, d), _questions(spark, d))
    return both.select("pergunta_id", F.posexplode("mensagens").alias("ordem", "m")).select("pergunta_id", "ordem", "m.role", "m.content")


_PROXIES = f"""acertos as (select a.pergunta_id, tipo, qw, list_intersect(qw, {_words('texto')}) as h from ampliado a join chunks_hierarquicos using (row_id) join (select pergunta_id, tipo, list_distinct({_words('pergunta')}) as qw from perguntas_benchmark) q on a.pergunta_id = q.pergunta_id),
proxies as (select pergunta_id, tipo, floor(len(list_distinct(flatten(list(h))))::double / len(any_value(qw)) * 1000 + 0.5) / 1000 as cobertura, floor(avg(case when len(h) > 0 then 1.0 else 0.0 end)::double * 1000 + 0.5) / 1000 as precisao from acertos group by 1, 2)"""


@query(f"with {_HYBRID}, {_PROXIES} select * from proxies")
def eval_proxies(spark: SparkSession, d: str) -> DataFrame:
    return answers.proxies(hybrid_retrieve(spark, d), _chunks(spark, d), _questions(spark, d), "row_id")


@query(f"""with {_HYBRID}, {_PROXIES}, m as (select tipo, count(*) as perguntas, floor(avg(cobertura) * 1000 + 0.5) / 1000 as cobertura, floor(avg(precisao) * 1000 + 0.5) / 1000 as precisao from proxies group by 1), g as (select *, floor((cobertura + precisao) / 2 * 1000 + 0.5) / 1000 as geral from m)
select *, row_number() over (order by geral desc, tipo) = 1 as melhor from g""")
def eval_summary(spark: SparkSession, d: str) -> DataFrame:
    return answers.summary(eval_proxies(spark, d), "tipo")


@query("select tipo, count(*) as perguntas, count(resposta_ref) as com_resposta from perguntas_benchmark group by 1")
def question_counts(spark: SparkSession, d: str) -> DataFrame:
    return _questions(spark, d).groupBy("tipo").agg(F.count("*").alias("perguntas"), F.count("resposta_ref").alias("com_resposta"))


@query("select pergunta_id, tipo, pergunta from perguntas_benchmark order by md5(pergunta_id || '-42'), pergunta_id limit 5")
def benchmark_sample(spark: SparkSession, d: str) -> DataFrame:
    return answers.sample(_questions(spark, d)).select("pergunta_id", "tipo", "pergunta")


_VARIANT = ", ".join(
    (
        _BM25.replace("posicao < 20", "posicao < 30"), _DENSE.replace("posicao < 20", "posicao < 30"), _FUSED.replace("posicao < 20", "posicao < 25"),
        _RERANKED.replace("qualify posicao < 5", "qualify posicao < 6"), _expanded_sql(False).replace("<= 5)", "<= 8)")
    )
)


@query(f"""with {_VARIANT}, dois as (select a.*, c.arquivo_origem from ampliado a join chunks_hierarquicos c using (row_id) qualify row_number() over (partition by a.pergunta_id, a.ato_id, arquivo_origem order by a.posicao) <= 2)
select pergunta_id, row_id, ato_id, tipo_documento, bruto, escore, n - 1 as posicao from (select *, row_number() over (partition by pergunta_id order by posicao) as n from dois) where n <= 5""")
def hybrid_variant(spark: SparkSession, d: str) -> DataFrame:
    return search.hybrid_variant(_chunks(spark, d), _questions(spark, d))


@query(f"""with {_VARIANT.split(", ordenado as (")[0]} select pergunta_id, row_id, ato_id, tipo_documento, bruto, escore, n - 1 as posicao from (select f.pergunta_id, row_id, ato_id, tipo_documento, f.escore as bruto, f.escore, row_number() over (partition by f.pergunta_id order by f.posicao) as n
    from (select * from fundido where posicao < 6) f join chunks_hierarquicos using (row_id) qualify row_number() over (partition by f.pergunta_id, ato_id, arquivo_origem order by f.posicao) <= 2) where n <= 5""".replace("row_number() over (partition by f.pergunta_id order by f.posicao) as n", "f.posicao as p").replace("select pergunta_id, row_id, ato_id, tipo_documento, bruto, escore, n - 1 as posicao from (select", "select pergunta_id, row_id, ato_id, tipo_documento, bruto, escore, row_number() over (partition by pergunta_id order by p) - 1 as posicao from (select").replace(") where n <= 5", ") qualify row_number() over (partition by pergunta_id order by p) <= 5"))
def hybrid_no_rerank(spark: SparkSession, d: str) -> DataFrame:
    return search.hybrid_variant(_chunks(spark, d), _questions(spark, d), use_reranking=False, use_expansion=False)


@query(chunk_sql.packed_documents(_context("titulo", "ato_id", "texto")))
def chunk_packed_documents(spark: SparkSession, d: str) -> DataFrame:
    return chunks.children_packed(_documents(spark, d))


@query(r"""select registro_id, case when p = 0 then 0.0 else floor(c * 10 / p + 0.5) / 10 end as densidade_texto, case when c = 0 then 0.0 else floor(t * 1000 / c + 0.5) / 1000 end as proporcao_tabela
    from (select registro_id, coalesce(caracteres_extraidos, 0)::double as c, coalesce(paginas, 0) as p, coalesce(list_sum(list_transform(list_filter(string_split(coalesce(texto, ''), chr(10)), lambda x: regexp_matches(x, '^[\s\x{a0}]*\|[^\n]*\|[\s\x{a0}]*$')), lambda x: length(x))), 0) as t from corpus_documentos)""")
def document_metrics(spark: SparkSession, d: str) -> DataFrame:
    return pages.document_metrics(_documents(spark, d))


@query(f"select pergunta_id, '{M.ASKED}' || pergunta as consulta from perguntas_benchmark")
def query_build(spark: SparkSession, d: str) -> DataFrame:
    return _questions(spark, d).select("pergunta_id", M.question_prompt(F.col("pergunta")).alias("consulta"))


@query(
    "select registro_id, case when n < 1024 then printf('%.1f B', n::double) when n < 1048576 then printf('%.1f KB', n / 1024.0::double) else printf('%.1f MB', n / 1048576.0::double) end as tamanho from (select registro_id, caracteres_extraidos * 64 as n from corpus_documentos where caracteres_extraidos is not null)"
)
def byte_sizes(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).where("caracteres_extraidos is not null").select(
        "registro_id", M.human_bytes(F.col("caracteres_extraidos").cast("long") * 64).alias("tamanho")
    )


@query(
    f"with {_SCORED} select d.autor as autor, count(*) as anexos, sum(coalesce(d.caracteres_extraidos, 0))::bigint as caracteres, count(*) filter (where {_SCORE} = 1) as plenos, count(*) filter (where d.tem_tabela) as com_tabela from corpus_documentos d join q using (registro_id) where d.tipo_documento = 'anexo' group by 1"
)
def annex_totals(spark: SparkSession, d: str) -> DataFrame:
    a = _scored(spark, d).where("tipo_documento = 'anexo'")
    return a.groupBy("autor").agg(
        F.count("*").alias("anexos"), F.sum(F.coalesce(F.col("caracteres_extraidos").cast("long"), F.lit(0))).alias("caracteres"),
        F.count_if(F.col("escore") == 1).alias("plenos"), F.count_if("tem_tabela").alias("com_tabela")
    )


@query(
    f"select tipo_documento, count(*) as documentos, sum(length(texto) - length({_layer1('texto')}))::bigint as removidos, count(*) filter (where length(texto) > length({_layer1('texto')})) as alterados from corpus_documentos where texto is not null group by 1"
)
def clean_totals(spark: SparkSession, d: str) -> DataFrame:
    gone = _documents(spark, d).where("texto is not null").select("tipo_documento", (F.length("texto") - F.length(C.boilerplate_removed(F.col("texto")))).alias("n"))
    return gone.groupBy("tipo_documento").agg(F.count("*").alias("documentos"), F.sum("n").cast("long").alias("removidos"), F.count_if(F.col("n") > 0).alias("alterados"))


@query(f"with {_PAGES} select registro_id, case when sum(length({_strip('texto')})) > 50 then 'tem_texto' else 'escaneado' end as classe from paginas group by 1")
def scanned_class(spark: SparkSession, d: str) -> DataFrame:
    return pages.scanned(pages.pages_of(_documents(spark, d), "registro_id", "texto"), "registro_id")


@query(
    r"""select registro_id, arquivo_origem, case lower(regexp_extract(arquivo_origem, '\.([^./]+)$', 1)) when 'pdf' then 'pdf' when 'html' then 'html' when 'htm' then 'html' when 'zip' then 'zip' when 'rar' then 'rar' when 'xlsx' then 'excel' when 'xlsm' then 'excel' when 'xls' then 'excel' else 'ignorado' end as leitor from corpus_documentos"""
)
def extension_dispatch(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).select("registro_id", "arquivo_origem", M.reader(F.col("arquivo_origem")).alias("leitor"))


@query("select registro_id, ano, arquivo_origem from corpus_documentos where ano in (2016, 2021) order by ano, arquivo_origem, registro_id limit 100")
def first_documents(spark: SparkSession, d: str) -> DataFrame:
    """The first documents by path of chosen years, as a trial run takes them."""
    return _documents(spark, d).where("ano in (2016, 2021)").select("registro_id", "ano", "arquivo_origem").orderBy("ano", "arquivo_origem", "registro_id").limit(100)


_METRICS = r"""select registro_id, case when p = 0 then 0.0::double else floor(c * 10 / p + 0.5) / 10 end as densidade_texto, case when c = 0 then 0.0::double else floor(t * 1000 / c + 0.5) / 1000 end as proporcao_tabela
    from (select registro_id, coalesce(caracteres_extraidos, 0)::double as c, coalesce(paginas, 0) as p, coalesce(list_sum(list_transform(list_filter(string_split(coalesce(texto, ''), chr(10)), lambda x: regexp_matches(x, '^[\s\x{a0}]*\|[^\n]*\|[\s\x{a0}]*$')), lambda x: length(x))), 0) as t from corpus_documentos)"""


@query(f"""with {_LOOKUP}, {_SCORED}, meta as (select {_WITH_METADATA} from corpus_documentos d left join lookup l on d.arquivo_origem = l.arquivo), medidas as ({_METRICS})
select m.*, densidade_texto, proporcao_tabela, caracteres_extraidos, cast({_SCORE} as double) as qualidade_score from meta m join medidas using (registro_id) join (select registro_id, c, p, s from q) using (registro_id) join (select registro_id, caracteres_extraidos from corpus_documentos) using (registro_id)""")
def document_build(spark: SparkSession, d: str) -> DataFrame:
    """Extracted text measured and brought together with its metadata, with defaults for files that have none."""
    score = C.quality(F.col("caracteres_extraidos").cast("double"), F.col("paginas"), F.size("paginas_suspeitas")).alias("qualidade_score")
    rows = _documents(spark, d).select("registro_id", "arquivo_origem", "caracteres_extraidos", *pages.metric_columns(), score)
    return acts.with_metadata(rows, acts.lookup(_records(spark, d)), "densidade_texto", "proporcao_tabela", "caracteres_extraidos", "qualidade_score")


@query(
    f"select row_id, {_words('texto').replace(', '.join(f"'{w}'" for w in STOPWORDS), ', '.join(f"'{w}'" for w in FEW_STOPWORDS))} as w from chunks_hierarquicos".replace(
        "select row_id, ", "select row_id, len(w) as n, array_to_string(w, ' ') as palavras from (select row_id, ", 1
    ) + ")"
)
def search_words_few(spark: SparkSession, d: str) -> DataFrame:
    """Search words by the shorter list of stopwords."""
    w = search_words(F.col("texto"), FEW_STOPWORDS)
    return _chunks(spark, d).select("row_id", F.size(w).alias("n"), F.array_join(w, " ").alias("palavras"))


@query(f"select pergunta_id, '{M.ASKED_AT_LENGTH}' || pergunta as consulta from perguntas_benchmark")
def query_build_at_length(spark: SparkSession, d: str) -> DataFrame:
    return _questions(spark, d).select("pergunta_id", M.question_prompt(F.col("pergunta"), M.ASKED_AT_LENGTH).alias("consulta"))


@query(f"""with {_HYBRID} select pergunta_id, posicao, concat_ws(chr(10), '━━━ DOCUMENTO ' || (posicao + 1) || ' ━━━', 'Tipo: ' || coalesce(upper(c.tipo_documento), ''), 'Ato: ' || coalesce(c.ato_id, ''), 'Título: ' || coalesce(titulo, ''), 'Publicação: ' || coalesce(publicacao, ''),
    'Situação: ' || coalesce(situacao, ''), case when coalesce(ementa, '') <> '' then 'Ementa: ' || ementa end, case when coalesce(contexto_juridico, '') <> '' then 'Localização: ' || contexto_juridico end, '', 'TRECHO:', coalesce(nullif(texto_pai, ''), texto, ''), '') as bloco
    from ampliado a join chunks_hierarquicos c using (row_id)""")
def context_blocks_rich(spark: SparkSession, d: str) -> DataFrame:
    return answers.context_blocks(hybrid_retrieve(spark, d), _chunks(spark, d), "row_id", rich=True)


def _echo(said: list[dict]) -> str:
    """A generator for tests: the question's last words, or an error for questions that ask how."""
    asked = said[-1]["content"].split("PERGUNTA: ")[-1].split("\n\n")[0]
    if asked.startswith("Como"):
        raise ValueError("sem modelo")
    return " ".join(asked.split(" ")[-4:])


_ANSWERS = f"""{_HYBRID}, achados as (select pergunta_id, list(coalesce(nullif(texto_pai, ''), texto) order by posicao) as ctx, string_agg(coalesce(c.ato_id, '') || '/' || coalesce(left(titulo, 100), ''), ';' order by posicao) as fontes, round(sum(escore), 6) as escores
    from ampliado a join chunks_hierarquicos c using (row_id) group by 1),
respostas as (select p.*, case when ctx is null then '{answers.NOTHING_FOUND}' when not starts_with(pergunta, 'Como') then array_to_string(string_split(pergunta, ' ')[-4:], ' ') end as resposta,
    case when ctx is not null and starts_with(pergunta, 'Como') then 'sem modelo' end as erro, coalesce(ctx, []) as ctx, coalesce(fontes, '') as fontes, coalesce(escores, 0.0) as escores from perguntas_benchmark p left join achados using (pergunta_id))"""


def _benchmark(spark: SparkSession, d: str) -> DataFrame:
    c, q = _chunks(spark, d), _questions(spark, d)
    return answers.benchmark(c, written(search.hybrid(c, q), "found"), q, _echo, "eco")


@query(
    f"with {_ANSWERS} select pergunta_id, 'eco' as modelo, pergunta, tipo, resposta_ref, resposta, erro, fontes, escores, array_to_string(ctx, chr(10)) as contextos from respostas"
)
def benchmark_run(spark: SparkSession, d: str) -> DataFrame:
    """All questions answered by a generator that echoes, errors kept; lists are shown as text."""
    r = _benchmark(spark, d)
    fontes = F.array_join(F.transform("fontes", lambda x: F.concat_ws("/", F.coalesce(x["ato_id"], F.lit("")), F.coalesce(x["titulo"], F.lit("")))), ";")
    escores = F.round(F.aggregate("fontes", F.lit(0.0), lambda a, x: a + x["escore"]), 6)
    return r.select(
        "pergunta_id", "modelo", "pergunta", "tipo", "resposta_ref", "resposta", "erro", fontes.alias("fontes"), escores.alias("escores"),
        F.array_join("contextos", "\n").alias("contextos")
    )


@query(f"""with {_ANSWERS}, w as (select pergunta_id, tipo, list_distinct({_words('pergunta')}) as q, list_distinct({_words('resposta')}) as a, list_transform(ctx, lambda t: list_distinct({_words('t')})) as c from respostas where erro is null)
select pergunta_id, 'eco' as modelo, tipo, case when len(a) = 0 then 0.0 else floor(len(list_intersect(a, list_distinct(flatten(c)))) / len(a)::double * 1000 + 0.5) / 1000 end as fidelidade,
    case when len(q) = 0 then 0.0 else floor(len(list_intersect(q, a)) / len(q)::double * 1000 + 0.5) / 1000 end as relevancia, case when len(c) = 0 then 0.0 else floor(len(list_filter(c, lambda x: len(list_intersect(x, q)) > 0)) / len(c)::double * 1000 + 0.5) / 1000 end as precisao from w""")
def benchmark_metrics(spark: SparkSession, d: str) -> DataFrame:
    return answers.result_metrics(_benchmark(spark, d))


@query(
    f"""select tipo_documento, count(*) as n, floor(avg(t) * 10 + 0.5) / 10 as media, min(t) as minimo, quantile_cont(t, 0.5) as q50, max(t) as maximo from (select tipo_documento, len({_pieces('texto_pai')}) as t from chunks_hierarquicos) group by 1"""
)
def chunk_describe_parents(spark: SparkSession, d: str) -> DataFrame:
    t = _chunks(spark, d).select("tipo_documento", P.count(F.col("texto_pai")).alias("t"))
    return t.groupBy("tipo_documento").agg(
        F.count("*").alias("n"), (F.floor(F.avg("t") * 10 + 0.5) / 10).alias("media"), F.min("t").alias("minimo"),
        F.percentile("t", F.lit(0.5)).alias("q50"), F.max("t").alias("maximo")
    )
