"""Hierarchical chunks of documents: split, fitted, capped, numbered and linked, all within a row's arrays, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselex.functions import pieces as P
from tesselex.functions.metadata import file_stem, strip
from tesselex.plans.lineage import written

#: Pieces of a child, of a parent, and of the overlap; short names and most chunks of each type.
CHILD, PARENT, OVERLAP = 256, 512, 50
SHORT = {"texto_integral": "ti", "voto": "vo", "nota_tecnica": "nt", "anexo": "an", "decisao": "de", "outro": "ou"}
CAPS = {"texto_integral": 200, "voto": 150, "nota_tecnica": 200, "anexo": 50, "decisao": 100, "outro": 50}
OTHER_CAP = 50
TRUNCATED = "documento truncado por exceder limite de chunks para tipo anexo"
TABLE = "[tabela]"
#: Where articles, numbered headings and parts of decisions begin, and the marker that names them.
ARTICLE_BEGINS = r"Art\.[\s ]*[0-9]|§[\s ]*[0-9]|Parágrafo[\s ]+[Úú]nico|Inciso[\s ]+[IVXLCDM]|CAPÍTULO[\s ]+[IVXLCDM]|SEÇÃO[\s ]+[IVXLCDM]|SUBSEÇÃO[\s ]+[IVXLCDM]"
ARTICLE_NAME = r"Art\.[\s ]*[0-9][0-9.ºo]*|§[\s ]*[0-9]+|Parágrafo[\s ]+[Úú]nico|Inciso[\s ]+[IVXLCDM]+|CAPÍTULO[\s ]+[IVXLCDM]+|SEÇÃO[\s ]+[IVXLCDM]+|SUBSEÇÃO[\s ]+[IVXLCDM]+"
HEADING_BEGINS = r"[0-9]+(?:\.[0-9]+)*\.?[\s ]+[A-ZÁÉÍÓÚÂÊÎÔÛÃÕ]|[IVXLCDM]+(?:\.[0-9]+)?[\s ]*[–\-—][\s ]*"
HEADING_NAME = r"[0-9]+(?:\.[0-9]+)*\.?|[IVXLCDM]+(?:\.[0-9]+)?[\s ]*[–\-—]?"
PART_BEGINS = r"(?:RELATÓRIO|VOTO|DECISÃO|EMENTA|ACÓRDÃO)(?![\p{L}\p{N}_])"
ROMAN_BEGINS = r"[\s ]*[IVXLCDM]+[\s ]*[-–—][\s ]*[A-ZÁÉÍÓÚÂÊÎÔÛÃÕ]"
PART_NAME = r"RELATÓRIO|VOTO|DECISÃO|EMENTA|ACÓRDÃO|[IVXLCDM]+(?:[\s ]*[-–—][\s ]*[\p{L}\p{N}_]+)?"

_UNIT = "array<struct<texto:string,contexto:string,modo:string>>"
_CHUNK = "array<struct<texto:string,contexto:string>>"


def segments(t: Column, begins: str, flags: str = "iu") -> Column:
    """Stripped parts of a text, each begun by a line that matches; blank ones are dropped."""
    return F.filter(F.transform(F.split(t, f"(?md{flags})(?=^(?:{begins}))"), strip), lambda x: x != "")


def named(parts: Column, name: str, flags: str = "iu", upper: bool = False) -> Column:
    """(texto, contexto, modo "ajuste"): the marker at a part's beginning as context."""

    def one(x: Column) -> Column:
        found = strip(F.regexp_extract(x, f"(?{flags})^({name})" if flags else f"^({name})", 1))
        return F.struct(x.alias("texto"), (F.upper(found) if upper else found).alias("contexto"), F.lit("ajuste").alias("modo"))

    return F.transform(parts, one)


def _whole(t: Column, mode: str) -> Column:
    return F.array(F.struct(t.alias("texto"), F.lit("").alias("contexto"), F.lit(mode).alias("modo")))


def runs(t: Column) -> Column:
    """array<struct<tabela, bloco>>: alternating runs of Markdown table lines and of other lines, the latter stripped and perhaps blank."""

    def of_lines(x: Column) -> Column:
        begin = F.filter(F.transform(x["f"], lambda f, i: F.when((i == 0) | (f != F.try_element_at(x["f"], F.greatest(i, F.lit(1)))), i + 1)), lambda i: i.isNotNull())
        ends = F.concat(F.slice(begin, 2, F.size(begin)), F.array(F.size(x["f"]) + 1))
        return F.zip_with(begin, ends, lambda i, j: of_run(F.element_at(x["f"], i), F.array_join(F.slice(x["l"], i, j - i), "\n")))

    of_run = lambda f, text: F.struct(f.alias("tabela"), F.when(f, text).otherwise(strip(text)).alias("bloco"))
    flagged = lambda lines: P.bound(F.struct(F.transform(lines["l"], lambda x: x.rlike(r"^[\s ]*\|[^\n]*\|[\s ]*$")).alias("f"), lines["l"].alias("l")), of_lines)
    return P.bound(F.struct(F.split(t, "\n").alias("l")), flagged)


def blocks(t: Column) -> Column:
    """The runs of a text, blank ones dropped."""
    return F.filter(runs(t), lambda b: b["bloco"] != "")


def fitted(t: Column, size: int = CHILD) -> Column:
    """A segment as pieces of at most `size`: whole if it fits, else lines packed greedily. A line that no longer fits is
    emitted on its own after the packed ones (in windows if too long), and packing starts afresh.
    """
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"), F.lit(0).alias("n"))

    def add(acc: Column, x: Column) -> Column:
        fits = acc["n"] + x["n"] <= size
        kept = F.concat(acc["out"], F.when(acc["cur"] != "", F.array(acc["cur"])).otherwise(F.array().cast("array<string>")))
        alone = F.when(x["n"] > size, P.windows(x["p"], size)).otherwise(F.array(x["p"]))
        return F.struct(
            F.when(fits, acc["out"]).otherwise(F.concat(kept, alone)).alias("out"),
            F.when(~fits, F.lit("")).when(acc["cur"] == "", x["p"]).otherwise(F.concat(acc["cur"], F.lit("\n"), x["p"])).alias("cur"),
            F.when(fits, acc["n"] + x["n"]).otherwise(F.lit(0)).alias("n"),
        )

    lines = F.filter(F.transform(F.split(t, "\n"), strip), lambda p: p != "")
    counted = F.transform(lines, lambda p: F.struct(p.alias("p"), P.count(p).alias("n")))
    packed = F.aggregate(counted, empty, add, lambda acc: F.concat(acc["out"], F.when(acc["cur"] != "", F.array(acc["cur"])).otherwise(F.array().cast("array<string>"))))
    return F.when(P.count(t) <= size, F.array(t)).otherwise(packed)


def table_rows(t: Column, size: int = CHILD) -> Column:
    """A Markdown table as tables of at most `size` pieces under its own header (all lines up to the separator). A row too
    long for that, and a table without rows or separator, stay whole.
    """
    none = F.array().cast("array<string>")
    empty = F.struct(none.alias("out"), F.lit("").alias("cur"), F.lit(0).alias("n"))

    def of_lines(x: Column) -> Column:
        at = F.coalesce(F.array_min(F.transform(x["l"], lambda y, i: F.when(y.rlike(r"^[\s ]*\|[-:| ]+\|[\s ]*$"), i + 1))), F.size(x["l"]))
        return P.bound(F.struct(x["l"].alias("l"), at.alias("at")), of_parts)

    def of_parts(x: Column) -> Column:
        head = F.array_join(F.slice(x["l"], 1, x["at"]), "\n")
        return P.bound(F.struct(head.alias("head"), P.count(head).alias("base"), F.slice(x["l"], x["at"] + 1, F.size(x["l"])).alias("rows")), of_rows)

    def of_rows(x: Column) -> Column:
        done = lambda acc: F.concat(acc["out"], F.when(acc["n"] > 0, F.array(F.concat(x["head"], acc["cur"]))).otherwise(none))

        def add(acc: Column, r: Column) -> Column:
            fits = x["base"] + acc["n"] + r["n"] <= size
            return F.struct(
                F.when(fits, acc["out"]).otherwise(done(acc)).alias("out"),
                F.when(fits, F.concat(acc["cur"], F.lit("\n"), r["r"])).otherwise(F.concat(F.lit("\n"), r["r"])).alias("cur"),
                F.when(fits, acc["n"] + r["n"]).otherwise(r["n"]).alias("n")
            )

        return F.when(F.size(x["rows"]) == 0, F.array(x["head"])).otherwise(
            F.aggregate(F.transform(x["rows"], lambda r: F.struct(r.alias("r"), P.count(r).alias("n"))), empty, add, done)
        )

    return F.when(P.count(t) <= size, F.array(t)).otherwise(P.bound(F.struct(F.split(t, "\n").alias("l")), of_lines))


def units(kind: Column, t: Column) -> Column:
    """What a document of this type is first cut into: (texto, contexto, modo), modo telling how a unit is made to fit."""
    articles = segments(t, ARTICLE_BEGINS)
    by_article = F.when(F.size(articles) > 1, named(articles, ARTICLE_NAME)).otherwise(_whole(t, "fixo"))
    parts, roman = segments(t, PART_BEGINS), segments(t, ROMAN_BEGINS, "")
    by_part = F.when(F.size(parts) > 1, named(parts, PART_NAME, "iu", True)).when(F.size(roman) > 1, named(roman, PART_NAME, "iu", True)).otherwise(_whole(t, "fixo"))

    def headed(b: Column) -> Column:
        s = segments(b, HEADING_BEGINS, "")
        return F.when(F.size(s) > 1, named(s, HEADING_NAME, "")).otherwise(_whole(b, "fixo"))

    table = lambda b: F.array(F.struct(b["bloco"].alias("texto"), F.lit(TABLE).alias("contexto"), F.lit("tabela").alias("modo")))
    by_heading = F.flatten(F.transform(blocks(t), lambda b: F.when(b["tabela"], table(b)).otherwise(headed(b["bloco"]))))
    by_table = F.flatten(F.transform(blocks(t), lambda b: F.when(b["tabela"], table(b)).otherwise(_whole(b["bloco"], "fixo"))))
    return F.when(kind == "texto_integral", by_article).when(kind == "decisao", by_part).when(kind == "nota_tecnica", by_heading).when(kind == "anexo", by_table).otherwise(_whole(t, "janela")).cast(_UNIT)


def cut(u: Column) -> Column:
    """array<struct<texto, contexto>> of all units of a document."""

    def one(x: Column) -> Column:
        texts = F.when(x["modo"] == "ajuste", fitted(x["texto"])).when(x["modo"] == "tabela", table_rows(x["texto"])).when(
            x["modo"] == "janela", P.windows(x["texto"], CHILD, OVERLAP)
        ).otherwise(P.windows(x["texto"], CHILD))
        return F.transform(texts, lambda c: F.struct(c.alias("texto"), x["contexto"].alias("contexto")))

    return F.flatten(F.transform(u, one)).cast(_CHUNK)


def _by_type(kind: Column, values: dict, other) -> Column:
    out = F.lit(other)
    for k, v in values.items():
        out = F.when(kind == k, F.lit(v)).otherwise(out)
    return out


def chunked(documents: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """One row per document with text: its chunks (capped) as an array, and how many there were before. Needs registro_id,
    arquivo_origem, tipo_documento, texto; other columns stay.
    """
    kind = F.coalesce("tipo_documento", F.lit("outro"))
    full = P.once(documents.where(strip(F.col("texto")) != ""), "__c", cut(units(kind, F.col("texto")))).withColumn("gerados", F.size("__c")).where("gerados > 0")
    cap = _by_type(kind, caps or CAPS, OTHER_CAP)
    return full.withColumn("limite", cap).withColumn("chunks", F.slice("__c", 1, F.col("limite"))).drop("__c")


def children(documents: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """One row per chunk: ids, place, neighbours, context, text and parent text (the chunk with its neighbours, cut to
    PARENT pieces from its head).
    """
    c = chunked(documents, caps)
    prefix = F.concat_ws("_", file_stem(F.col("arquivo_origem")), _by_type(F.coalesce("tipo_documento", F.lit("outro")), SHORT, "ou"))
    ident = lambda letter, n: F.concat("__p", F.lit(f"_{letter}"), F.when(n < 1000, F.lpad(n.cast("string"), 3, "0")).otherwise(n.cast("string")))
    rows = c.withColumn("__p", prefix).withColumn("total_chunks", F.size("chunks"))

    def with_neighbours(x: Column) -> Column:
        near = lambda i: F.array_join(
            F.transform(F.slice(x, F.greatest(i, F.lit(1)), F.least(i + 2, F.size(x)) - F.greatest(i, F.lit(1)) + 1), lambda y: y["texto"]), "\n"
        )
        return F.transform(x, lambda y, i: F.struct(y["texto"].alias("texto"), y["contexto"].alias("contexto"), P.head(near(i), PARENT).alias("pai")))

    rows = P.once(rows, "__n", P.bound(F.col("chunks"), with_neighbours))
    rows = rows.select(
        "registro_id", "ato_id", "tipo_documento", "ano", "__p", "gerados", "limite", "total_chunks", F.posexplode("__n").alias("__i", "__x")
    ).withColumn("numero_chunk", F.col("__i") + 1)
    n, total = F.col("numero_chunk"), F.col("total_chunks")
    return rows.select(
        "registro_id", "ato_id", "tipo_documento", "ano",
        ident("c", n).alias("chunk_id"), ident("p", n).alias("chunk_pai_id"),
        F.col("__x.contexto").alias("contexto_juridico"), "numero_chunk", "total_chunks",
        (F.floor(n * 10000 / total + 0.5) / 10000).alias("posicao_relativa"),
        F.when(n > 1, ident("c", n - 1)).alias("chunk_anterior_id"), F.when(n < total, ident("c", n + 1)).alias("chunk_proximo_id"),
        F.col("__x.texto").alias("texto"), F.col("__x.pai").alias("texto_pai"),
        F.when((F.col("gerados") > F.col("limite")) & (F.col("tipo_documento") == "anexo"), F.lit(TRUNCATED)).alias("aviso"),
    )


def truncated(documents: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """(registro_id, tipo_documento, chunks_gerados, chunks_mantidos, tokens_totais) of documents over their cap."""
    c = chunked(documents, caps).where(F.col("gerados") > F.col("limite"))
    return c.select(
        "registro_id", F.coalesce("tipo_documento", F.lit("outro")).alias("tipo_documento"), F.col("gerados").alias("chunks_gerados"),
        F.col("limite").alias("chunks_mantidos"), P.count(F.col("texto")).alias("tokens_totais")
    )


def packed(t: Column, size: int = CHILD, least: int = 100) -> Column:
    """Blank-line units of a text, see pack_units."""
    return pack_units(F.filter(F.transform(F.split(t, r"\n[\s ]*\n"), strip), lambda p: p != ""), size, least)


def pack_units(units_in: Column, size: int = CHILD, least: int = 100) -> Column:
    """The other packing: units joined greedily by a blank line, a unit that no longer fits beginning the next batch; units
    over the size go in windows of their own; results under `least` characters are dropped.
    """
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"), F.lit(0).alias("n"))
    none = F.array().cast("array<string>")

    def add(acc: Column, x: Column) -> Column:
        fits, big = acc["n"] + x["n"] <= size, x["n"] > size
        kept = F.concat(acc["out"], F.when(acc["cur"] != "", F.array(acc["cur"])).otherwise(none))
        return F.struct(
            F.when(big, F.concat(kept, P.windows(x["p"], size))).when(fits, acc["out"]).otherwise(kept).alias("out"),
            F.when(big, F.lit("")).when(fits & (acc["cur"] != ""), F.concat(acc["cur"], F.lit("\n\n"), x["p"])).otherwise(x["p"]).alias("cur"),
            F.when(big, F.lit(0)).when(fits, acc["n"] + x["n"]).otherwise(x["n"]).alias("n"),
        )

    units_ = F.transform(units_in, lambda p: F.struct(p.alias("p"), P.count(p).alias("n")))
    done = F.aggregate(units_, empty, add, lambda acc: F.concat(acc["out"], F.when(acc["cur"] != "", F.array(acc["cur"])).otherwise(none)))
    return F.filter(F.transform(done, strip), lambda x: F.length(x) >= least)


#: Fixed values of the packed variant: least characters of a chunk, its caps, header size and overlap of annexes.
LEAST_CHARS, HEADER_PIECES, ANNEX_OVERLAP = 100, 50, 20
PACKED_CAPS = {"texto_integral": 120, "voto": 80, "nota_tecnica": 100, "anexo": 150, "decisao": 50, "outro": 40}
_BLANK = r"\n[\s ]*\n+"


def by_pieces(t: Column, size: int | Column, overlap: int = 0) -> Column:
    """A stripped text whole if it fits, else its windows, stripped, those under LEAST_CHARS characters dropped."""
    p = P.pieces(strip(t))

    def cut_(x: Column) -> Column:
        step = size - overlap if isinstance(size, int) else size - F.lit(overlap)
        last = F.greatest(F.ceil((F.size(x) - size) / step), F.lit(0)).cast("int")
        many = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: strip(F.array_join(F.slice(x, (i * step + 1).cast("int"), size if isinstance(size, Column) else F.lit(size)), ""))
        )
        whole = F.when(F.size(x) > 0, F.array(F.array_join(x, ""))).otherwise(F.array().cast("array<string>"))
        return F.when(F.size(x) <= size, whole).otherwise(F.filter(many, lambda c: F.length(c) >= LEAST_CHARS))

    return F.flatten(F.transform(F.array(p), cut_))


def _split_where(t: Column, begins: str) -> Column:
    return F.filter(F.transform(F.split(t, f"(?={begins})"), strip), lambda x: x != "")


def packed_by_type(kind: Column, t: Column, title: Column) -> Column:
    """Chunks of the packed variant: articles, else paragraphs, else blank lines, packed; notes by numbered sections;
    annexes in windows under their first three lines (the title if these are long).
    """
    lines = F.filter(F.transform(F.split(t, _BLANK), strip), lambda x: x != "")
    articles, paragraphs = _split_where(t, r"(?<![\p{L}\p{N}_])Art\.[\s ]*[0-9]"), _split_where(t, r"§[\s ]*[0-9]|(?<![\p{L}\p{N}_])Parágrafo único(?![\p{L}\p{N}_])")
    sections = _split_where(t, r"\n[\s ]*[0-9]+\.[\s ]*[A-Z]")
    integral = F.when(F.size(articles) >= 2, articles).when(F.size(paragraphs) >= 2, paragraphs).otherwise(lines)
    note = F.when(F.size(sections) >= 2, sections).otherwise(lines)
    first = lambda x: strip(F.array_join(F.slice(x["l"], 1, 3), "\n"))
    headed = lambda x: P.bound(F.struct(x["l"].alias("l"), F.when(P.count(first(x)) > HEADER_PIECES, F.coalesce(title, F.lit(""))).otherwise(first(x)).alias("h")), sized)
    sized = lambda x: P.bound(
        F.struct(
            x["h"].alias("h"),
            F.when(P.count(x["h"]) > 0, F.array_join(F.slice(x["l"], 4, F.size(x["l"])), "\n")).otherwise(F.array_join(x["l"], "\n")).alias("body"),
            F.greatest(CHILD - P.count(x["h"]) - 5, F.lit(100)).alias("n")
        ),
        under
    )
    under = lambda x: F.transform(by_pieces(x["body"], x["n"], ANNEX_OVERLAP), lambda c: F.when(x["h"] != "", F.concat(x["h"], F.lit("\n\n"), c)).otherwise(c))
    annex = P.bound(F.struct(F.split(t, "\n").alias("l")), headed)
    return F.when(
        kind == "texto_integral", pack_units(integral)
    ).when(kind == "nota_tecnica", pack_units(note)).when(kind == "decisao", pack_units(lines)).when(kind == "anexo", annex).otherwise(by_pieces(t, CHILD, OVERLAP))


def children_packed(documents: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """One row per chunk of the packed variant with its size and parent: neighbours joined by blank lines; over PARENT
    pieces, half of what the chunk leaves goes to the end of the one before and half to the beginning of the next, none
    if it leaves nothing.
    """
    kind = F.coalesce("tipo_documento", F.lit("outro"))
    c = P.once(documents.where(strip(F.col("texto")) != ""), "__c", packed_by_type(kind, F.col("texto"), F.col("titulo")))
    kept = F.filter(F.transform(F.slice("__c", F.lit(1), _by_type(kind, caps or PACKED_CAPS, OTHER_CAP)), strip), lambda x: F.length(x) >= LEAST_CHARS)
    c = P.once(c, "__k", kept).withColumn("total_chunks", F.size("__k"))
    near = P.bound(
        F.col("__k"),
        lambda x: F.transform(
            x,
            lambda y, i: F.struct(
                y.alias("texto"), F.when(i > 0, F.try_element_at(x, F.greatest(i, F.lit(1)))).alias("antes"),
                F.try_element_at(x, i + 2).alias("depois")
            )
        )
    )
    rows = P.once(c, "__n", near).select("registro_id", "ato_id", "tipo_documento", "titulo", "ano", "total_chunks", F.posexplode("__n").alias("chunk_idx", "__x"))
    rows = rows.select("*", F.col("__x.texto").alias("texto"), F.col("__x.antes").alias("__b"), F.col("__x.depois").alias("__a")).drop("__x")
    none = lambda x: F.nullif(x, F.lit(""))
    rows = rows.withColumn("tokens", P.count(F.col("texto")))
    whole = F.concat_ws("\n\n", "__b", "texto", "__a")
    half = F.floor((F.lit(PARENT) - F.col("tokens")) / 2).cast("int")
    tail = F.when(half > 0, strip(F.array_join(F.slice(P.pieces(F.col("__b")), F.greatest(P.count(F.col("__b")) - half + 1, F.lit(1)), half), "")))
    front = F.when(half > 0, strip(F.array_join(F.slice(P.pieces(F.col("__a")), F.lit(1), half), "")))
    parent = F.when(P.count(whole) <= PARENT, whole).otherwise(F.concat_ws("\n\n", none(tail), "texto", none(front)))
    return rows.select(
        "registro_id", "ato_id", "tipo_documento", "ano", "chunk_idx", "total_chunks", "tokens",
        legal_context(F.col("titulo"), F.col("ato_id"), F.col("texto")).alias("contexto_juridico"), "texto", parent.alias("texto_pai")
    )


def legal_context(title: Column, act: Column, t: Column) -> Column:
    """Title (or act) with the first article and the first paragraph that a text names."""
    art, par = F.regexp_extract(t, r"(?<![\p{L}\p{N}_])Art\.[\s ]*([0-9]+)", 1), F.regexp_extract(t, r"§[\s ]*([0-9]+)", 1)
    a = F.when(art != "", F.concat(F.lit("Art. "), art))
    p = F.when(par != "", F.concat(F.lit("§"), par)).when(t.rlike("[Pp]arágrafo único"), F.lit("Parágrafo único"))
    both = F.concat_ws(", ", a, p)
    base = F.coalesce(F.nullif(title, F.lit("")), act)
    return F.when(both == "", base).otherwise(F.concat_ws(" - ", base, both))


def numbered(df: DataFrame, name: str, order: str) -> DataFrame:
    """`df` with a number from 0 by a column without repeats: rows are laid into ranges, numbered within each, and moved on
    by the sizes of the ranges before.
    """
    ranged = written(df.repartitionByRange(order).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__n"))  # one row a range
    before = sizes.select("__range", F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__range").orderBy(order)) - 1
    return ranged.withColumn("__own", own).join(before, "__range").withColumn(
        name, (F.col("__own") + F.col("__before")).cast("long")
    ).drop("__own", "__before", "__range")


def index_rows(chunks: DataFrame) -> DataFrame:
    """Chunks as the index takes them: source derived from chunk_id, year as a number, linha a stable row number by
    chunk_id (of repeats the lowest row_id stays).
    """
    w = Window.partitionBy("chunk_id").orderBy("row_id")
    one = chunks.select("row_id", "chunk_id", "ano", "tipo_documento").withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    year, source = F.coalesce(F.col("ano").try_cast("int"), F.lit(0)), F.regexp_replace("chunk_id", "_c[0-9]+$", "")
    return numbered(one, "linha", "chunk_id").select(
        "linha", "row_id", "chunk_id", source.alias("arquivo_origem"), year.alias("ano"),
        F.coalesce("tipo_documento", F.lit("")).alias("tipo_documento")
    )


#: Types of which one document with so many pieces is shown.
SHOWN_TYPES, SHOWN_PIECES = ("texto_integral", "voto", "nota_tecnica", "anexo", "decisao"), 80


def exemplars(documents: DataFrame) -> DataFrame:
    """(tipo_documento, registro_id, arquivo_origem): of each type shown the first document of SHOWN_PIECES pieces or more,
    by year and file name; a null year is 0.
    """
    rows = documents.where(F.col("tipo_documento").isin(*SHOWN_TYPES) & (P.count(F.col("texto")) >= SHOWN_PIECES))
    first = rows.groupBy("tipo_documento").agg(F.min(F.struct(F.coalesce("ano", F.lit(0)).alias("ano"), "arquivo_origem", "registro_id")).alias("x"))
    return first.select("tipo_documento", "x.registro_id", "x.arquivo_origem")


def passage(context: Column, t: Column) -> Column:
    """What is embedded: the text, after its context in brackets where there is one."""
    return F.when(F.coalesce(context, F.lit("")) != "", F.concat(F.lit("passage: ["), context, F.lit("] "), t)).otherwise(F.concat(F.lit("passage: "), t))
