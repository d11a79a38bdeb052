"""Names, types and dates of acts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What marks a document type, in the order in which they are tried.
NOTE_PATTERN = r"nota[\s ]+t[eé]cnica"
NOTE_ABBREVIATION = r"^nt[\s .]"
FULL_TEXT_PATTERN = r"texto[\s ]+i+ntegr"
FULL_TEXT_NAMES = ("integral", "texto", "pdf")
ANNEX_PATTERN = r"^(anexo|sub?m[oó]dulo|m[oó]dulo($|[^\p{L}\p{N}_]))"
ANNEX_WORDS = (
    "base de dado", "base de dao", "planilha", "memória de cálculo", "memoria de calculo", "exposição de motivos", "exposicao de motivos",
    "programa nodal", "simulador de tarifa", "glossário", "glossario", "plano anual", "proinfa", "rag - resultado", "resultado leilão",
    "região norte", "regiao norte", "região sul", "regiao sul", "região nordeste", "regiao nordeste", "região sudeste", "regiao sudeste", "região centro", "regiao centro", "site 1",
)
SPACE = r"[\s ]"


def strip(c: Column) -> Column:
    """Without white space at either end, no-break spaces included."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r\xa0"))


def file_stem(name: Column) -> Column:
    """Last part of a path without its extension."""
    return F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"(?<=.)\.[^.]*$", "")


def act_id(name: Column) -> Column:
    """{type}_{number}_{year} of a file name; one leading a or n is dropped from a longer type. The stem itself where it
    has no such form.
    """
    stem = F.regexp_replace(F.lower(file_stem(name)), r"_[0-9]+$", "")
    part = lambda i: F.regexp_extract(stem, r"^([a-z]+)(20[0-9]{2})([0-9]+)", i)
    kind = F.when(part(1).rlike("^[an]."), F.substring(part(1), 2, 1000)).otherwise(part(1))
    return F.when(part(1) == "", stem).when(part(1) != "", F.concat_ws("_", kind, part(3), part(2)))


def document_type(raw: Column) -> Column:
    """One of nota_tecnica, voto, texto_integral, decisao, anexo, outro; null counts as empty."""
    t = F.lower(strip(F.regexp_replace(F.coalesce(raw, F.lit("")), rf":+{SPACE}*$", "")))
    words = F.lit(False)
    for w in ANNEX_WORDS:
        words = words | F.contains(t, F.lit(w))
    return (
        F.when(t.rlike(NOTE_PATTERN) | t.rlike(NOTE_ABBREVIATION) | (t == "nt"), "nota_tecnica")
        .when(F.startswith(t, F.lit("voto")), "voto")
        .when(t.rlike(FULL_TEXT_PATTERN) | t.isin(*FULL_TEXT_NAMES) | F.startswith(t, F.lit("texto original")) | (F.startswith(t, F.lit("texto")) & (F.length(t) <= 6)), "texto_integral")
        .when(F.contains(t, F.lit("decis")), "decisao")
        .when(t.rlike(ANNEX_PATTERN) | words, "anexo")
        .otherwise("outro")
    )


def clean_field(c: Column) -> Column:
    """Without a label before the first colon and a print prompt at the end, white space made single; null if nothing is left."""
    s = strip(F.regexp_replace(c, r"^[A-ZÀ-ÿa-z\s ]+:[\s ]*", ""))
    s = strip(F.regexp_replace(s, rf"{SPACE}+", " "))
    return F.nullif(strip(F.regexp_replace(s, rf"(?i){SPACE}*Imprimir{SPACE}*$", "")), F.lit(""))


def iso_date(c: Column) -> Column:
    """First dd/mm/yyyy as yyyy-mm-dd, not checked for validity; null without one."""
    part = lambda i: F.regexp_extract(c, r"([0-9]{2})/([0-9]{2})/([0-9]{4})", i)
    return F.when(part(1) != "", F.concat_ws("-", part(3), part(2), part(1)))


def file_of_url(url: Column) -> Column:
    """Last segment of a URL before its query, or "arquivo"."""
    return F.coalesce(F.nullif(F.element_at(F.split(F.element_at(F.split(url, "/"), -1), r"\?"), 1), F.lit("")), F.lit("arquivo"))


def distributor(url: Column) -> Column:
    """Name between ANEXO_yyyy_ and _dspN in the file name."""
    return F.regexp_replace(F.regexp_replace(file_stem(url), "^ANEXO_[0-9]{4}_", ""), "_dsp[0-9]+$", "")


def last_url(line: Column) -> Column:
    """The right-most URL of a log line; null without one."""
    found = F.regexp_extract_all(line, F.lit(r"(https?://[^\s ]+)"), 1)
    return F.when(F.size(found) > 0, F.element_at(found, -1))


def failure(status: Column, message: Column) -> Column:
    """Label of a failed download; the status goes before the message."""
    m = F.lower(F.coalesce(message, F.lit("")))
    has = lambda *w: F.coalesce(*[F.when(F.contains(m, F.lit(x)), True) for x in w], F.lit(False))
    return (
        F.when(status == 404, "HTTP_404_nao_encontrado")
        .when(status == 403, "HTTP_403_acesso_negado")
        .when(status == 429, "HTTP_429_rate_limit")
        .when(status >= 500, F.concat(F.lit("HTTP_"), status.cast("string"), F.lit("_erro_servidor")))
        .when(status.isNotNull() & (status != 200), F.concat(F.lit("HTTP_"), status.cast("string")))
        .when(has("timeout", "timed out"), "timeout")
        .when(has("ssl", "certificate"), "erro_ssl")
        .when(has("connect"), "erro_conexao")
        .otherwise("erro_desconhecido")
    )


def human_bytes(n: Column) -> Column:
    """Size with one decimal (ties to even) in units of 1024."""
    out = F.format_string("%.1f PB", F.bround(n / F.lit(1024.0**5), 1))
    for i, unit in reversed(list(enumerate(("B", "KB", "MB", "GB", "TB")))):
        out = F.when(n < 1024 ** (i + 1), F.format_string(f"%.1f {unit}", F.bround(n / F.lit(1024.0**i), 1))).otherwise(out)
    return F.when(n.isNotNull(), out)


#: The instruction before a question that is embedded, of either variant.
ASKED = "Instruct: Given a question about Brazilian electric sector regulations, retrieve relevant legal passages\nQuery: "


ASKED_AT_LENGTH = "Instruct: Given a question about Brazilian electric sector regulations (ANEEL legislation), retrieve the most relevant legal passages that directly answer the question.\nQuery: "


def question_prompt(c: Column, instruction: str = ASKED) -> Column:
    return F.concat(F.lit(instruction), c)


def year_of_path(path: Column, folder: str = "pdfs") -> Column:
    """The folder after `folder` as a number; null where it is none."""
    return F.nullif(F.regexp_extract(path, f"(?:^|/){folder}/([^/]+)/", 1), F.lit("")).try_cast("int")


#: What reads a file of this ending.
READERS = {"pdf": "pdf", "html": "html", "htm": "html", "zip": "zip", "rar": "rar", "xlsx": "excel", "xlsm": "excel", "xls": "excel"}


def reader(name: Column) -> Column:
    """The reader of a file by its ending, "ignorado" where there is none."""
    ending = F.lower(F.regexp_extract(name, r"\.([^./]+)$", 1))
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in READERS.items() for x in pair]), ending), F.lit("ignorado"))
