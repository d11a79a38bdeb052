"""Pages of documents: repeated lines, validity, tables, document rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselex.functions import cleaning as C
from tesselex.functions import pieces as P
from tesselex.functions.metadata import strip
from tesselex.operators.chunks import runs

#: Fixed values of table detection: characters of a line, of a cell, cells of a line, lines of a table.
LINE_CHARS, CELL_CHARS, LINE_CELLS, TABLE_LINES = 20, 3, 3, 4


def page_array(text: Column, lines: int = 10) -> Column:
    """A text cut into pages of so many lines, for sources that keep no pages."""
    cut = lambda x: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(x["l"]) - 1) / lines).cast("int")), lambda i: F.array_join(F.slice(x["l"], i * lines + 1, lines), "\n")
    )
    return P.bound(F.struct(F.split(text, "\n").alias("l")), cut)


def pages_of(documents: DataFrame, key: str, text: str, lines: int = 10) -> DataFrame:
    """(key, pagina, texto): a row per page of page_array."""
    return documents.where(F.col(text).isNotNull()).select(key, F.posexplode(page_array(F.col(text), lines)).alias("pagina", "texto"))


def by_document(pages: DataFrame, key: str) -> DataFrame:
    """(key, paginas array<string>): page rows (key, pagina, texto) brought together, for sources that have a row per page.
    The one shuffle that the functions below ever need.
    """
    rows = pages.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pagina", "texto"))).alias("p"))
    return rows.select(key, F.transform("p", lambda x: x["texto"]).alias("paginas"))


def repeated(pages: Column) -> Column:
    """array<struct<linha, paginas>>: lines over 5 characters among the first and last three of at least max(2, 0.3 * pages) of a document's pages.

    Lines are sorted, so a line stands often enough where it equals the one so many places on; nothing is compared all with all.
    """

    def ends(page: Column) -> Column:
        lines = F.filter(F.transform(F.split(page, "\n"), strip), lambda x: x != "")
        return P.bound(
            F.struct(lines.alias("l")),
            lambda x: F.array_distinct(
                F.filter(
                    F.when(F.size(x["l"]) > 3, F.concat(F.slice(x["l"], 1, 3), F.slice(x["l"], F.greatest(F.size(x["l"]) - 2, F.lit(1)), 3))).otherwise(x["l"]),
                    lambda y: F.length(y) > 5
                )
            )
        )

    def often(x: Column) -> Column:
        last = F.size(x["s"]) - x["m"] + 1
        at = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        same = F.filter(at, lambda i: F.element_at(x["s"], i) == F.element_at(x["s"], i + x["m"] - 1))
        lines = F.array_distinct(F.transform(same, lambda i: F.element_at(x["s"], i)))
        return F.transform(lines, lambda y: F.struct(y.alias("linha"), F.size(F.filter(x["s"], lambda z: z == y)).alias("paginas")))

    least = F.greatest(F.lit(2), F.ceil(F.size(pages) * 0.30)).cast("int")
    return P.bound(F.struct(F.array_sort(F.flatten(F.transform(pages, ends))).alias("s"), least.alias("m")), often)


def repeated_lines(documents: DataFrame, key: str, pages: Column) -> DataFrame:
    """(key, linha, paginas) of every document's repeated lines."""
    return documents.select(key, F.explode(repeated(pages)).alias("r")).select(key, "r.linha", F.col("r.paginas").cast("long").alias("paginas"))


def patterns_of(pages: Column) -> Column:
    return F.transform(repeated(pages), lambda x: x["linha"])


def three_layers(raw: Column, patterns: Column) -> Column:
    """struct<texto, removidos> of a text: all three layers; what the second removes is not counted."""
    one = F.struct(raw.alias("t0"), C.boilerplate_removed(raw).alias("t1"))
    two = lambda x: P.bound(F.struct(x["t0"].alias("t0"), x["t1"].alias("t1"), C.normalised(x["t1"]).alias("t2")), three)
    three = lambda x: P.bound(F.struct(x["t0"].alias("t0"), x["t1"].alias("t1"), x["t2"].alias("t2"), C.without_patterns(x["t2"], patterns).alias("t")), done)
    done = lambda x: F.array(F.struct(x["t"].alias("texto"), (F.length(x["t0"]) - F.length(x["t1"]) + F.length(x["t2"]) - F.length(x["t"])).alias("removidos")))
    return F.element_at(P.bound(one, two), 1)


def cleaned(documents: DataFrame, key: str, text: str, pages: Column) -> DataFrame:
    """(key, texto, removidos) of a text column by the lines that its own pages repeat, within the row."""
    found = P.once(documents, "__p", patterns_of(pages))
    return P.once(found, "__t", three_layers(F.col(text), F.col("__p"))).select(key, "__t.texto", "__t.removidos")


def validity(pages: DataFrame, key: str) -> DataFrame:
    """(key, pagina, suspeita, razao_alfa): razao_alfa in thousandths; a short page is not suspect and has 1000."""
    share = C.alpha_share(F.col("texto"))
    return pages.select(
        key, "pagina", F.coalesce(share < C.LEAST_ALPHA, F.lit(False)).alias("suspeita"),
        F.coalesce(F.floor(share * 1000 + 0.5), F.lit(1000)).cast("int").alias("razao_alfa")
    )


def is_table_line(line: Column) -> Column:
    s = strip(line)
    return (F.length(s) >= LINE_CHARS) & F.contains(s, F.lit("   ")) & (F.size(F.filter(F.split(s, " {3,}"), lambda c: F.length(strip(c)) >= CELL_CHARS)) >= LINE_CELLS)


def markdown(lines: Column) -> Column:
    """Lines with cells three spaces apart as a Markdown table, its first line the header, short rows padded."""
    cells = F.transform(lines, lambda x: F.filter(F.transform(F.split(strip(x), " {3,}"), strip), lambda c: c != ""))
    width = F.array_max(F.transform(cells, F.size))
    row = lambda c: F.concat(F.lit("| "), F.array_join(F.concat(c, F.array_repeat(F.lit(""), width - F.size(c))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    rows = F.transform(cells, row)
    return F.array_join(F.concat(F.slice(rows, 1, 1), F.array(rule), F.slice(rows, 2, 1_000_000)), "\n")


def layout(lines: Column, patterns: Column) -> Column:
    """struct<tabelas, chars_tabela, texto, removidos> of an array of laid-out lines, within the row.

    Runs of at least four table lines become Markdown, other text is cleaned by all three layers, parts are joined by a
    blank line. A shorter run goes to the text that follows; the text before it is a part of its own.
    """
    none = F.array().cast("array<string>")

    def of_lines(x: Column) -> Column:
        begin = F.filter(F.transform(x["f"], lambda f, i: F.when((i == 0) | (f != F.try_element_at(x["f"], F.greatest(i, F.lit(1)))), i + 1)), lambda i: i.isNotNull())
        ends = F.concat(F.slice(begin, 2, F.size(begin)), F.array(F.size(x["f"]) + 1))
        run = lambda i, j: F.struct(F.element_at(x["f"], i).alias("tabela"), F.slice(x["l"], i, j - i).alias("linhas"))
        return P.bound(F.struct(F.zip_with(begin, ends, run).alias("r")), of_runs)

    def of_runs(x: Column) -> Column:
        table = lambda r: r["tabela"] & (F.size(r["linhas"]) >= TABLE_LINES)
        short = lambda r: r["tabela"] & (F.size(r["linhas"]) < TABLE_LINES)
        text = lambda lines: three_layers(F.array_join(lines, "\n"), patterns)

        def part(r: Column, i: Column) -> Column:
            after, before = F.try_element_at(x["r"], i + 2), F.try_element_at(x["r"], F.greatest(i, F.lit(1)))
            own = F.concat(r["linhas"], F.when(short(r), F.coalesce(after["linhas"], none)).otherwise(none))
            merged = (i > 0) & short(before)
            made = F.when(table(r), F.struct(markdown(r["linhas"]).alias("texto"), F.lit(0).alias("removidos"))).when(~merged, text(own))
            return F.struct(table(r).alias("mesa"), made.alias("m"))

        return P.bound(F.struct(F.filter(F.transform(x["r"], part), lambda y: y["m"].isNotNull()).alias("p")), joined)

    def joined(x: Column) -> Column:
        add = lambda a, n: a + n
        tables = F.filter(x["p"], lambda y: y["mesa"])
        kept = F.filter(x["p"], lambda y: y["mesa"] | (strip(y["m"]["texto"]) != ""))
        return F.array(F.struct(
            F.size(tables).cast("long").alias("tabelas"),
            F.aggregate(tables, F.lit(0).cast("long"), lambda a, y: add(a, F.length(y["m"]["texto"]))).alias("chars_tabela"),
            F.array_join(F.transform(kept, lambda y: y["m"]["texto"]), "\n\n").alias("texto"),
            F.aggregate(x["p"], F.lit(0).cast("long"), lambda a, y: add(a, y["m"]["removidos"])).alias("removidos"),
        ))

    return F.element_at(P.bound(F.struct(F.transform(lines, is_table_line).alias("f"), lines.alias("l")), of_lines), 1)


def laid_out(documents: DataFrame, key: str, lines: Column, patterns: Column) -> DataFrame:
    """(key, tabelas, chars_tabela, texto, removidos) of documents given as arrays of laid-out lines."""
    found = P.once(documents, "__p", patterns)
    return P.once(found, "__l", layout(lines, F.col("__p"))).select(key, "__l.*")


def lines_of(documents: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, linha_no, linha) of a text column."""
    return documents.select(key, F.posexplode(F.split(text, "\n")).alias("linha_no", "linha"))


def table_blocks(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, ordem, tabela, bloco): alternating Markdown tables and text in order from 1, within the row; blank text is dropped."""
    found = documents.where(F.col(text).isNotNull()).select(key, F.posexplode(runs(F.col(text))).alias("i", "b"))
    return found.select(key, (F.col("i") + 1).cast("long").alias("ordem"), "b.tabela", "b.bloco").where("bloco <> ''")


def rollup(documents: DataFrame, key: str, pages: Column) -> DataFrame:
    """(key, paginas, caracteres, suspeitas, tabelas, chars_tabela, removidos, texto) of documents given as arrays of
    pages: every page laid out and cleaned by the lines that the pages repeat, pages without text left out, the others
    joined by a blank line. Within the row; see by_document for page rows.
    """
    rows = P.once(P.once(documents, "__pages", pages), "__p", patterns_of(F.col("__pages")))
    rows = P.once(rows, "__l", F.transform("__pages", lambda t: layout(F.split(t, "\n"), F.col("__p"))))
    total = lambda name: F.aggregate("__l", F.lit(0).cast("long"), lambda a, x: a + x[name])
    text = F.array_join(F.filter(F.transform("__l", lambda x: x["texto"]), lambda t: strip(t) != ""), "\n\n")
    suspect = F.size(F.filter("__pages", lambda t: F.coalesce(C.alpha_share(t) < C.LEAST_ALPHA, F.lit(False))))
    rows = rows.select(
        key, F.size("__pages").cast("long").alias("paginas"), suspect.cast("long").alias("suspeitas"),
        *[total(c).alias(c) for c in ("tabelas", "chars_tabela", "removidos")], text.alias("texto")
    )
    return rows.select(key, "paginas", F.length("texto").alias("caracteres"), "suspeitas", "tabelas", "chars_tabela", "removidos", "texto")


def layout_lines(words: DataFrame, key: str) -> DataFrame:
    """(key, y, linha) of positioned words (key, x0, x1, y0, word): rows of 5 points, words by x0, three spaces where the
    gap is over 15 points.
    """
    w = Window.partitionBy(key, "y").orderBy("x0", "x1", "word")
    placed = words.withColumn("y", (F.bround(F.col("y0") / 5) * 5).cast("int")).withColumn("gap", F.col("x0") - F.lag("x1").over(w))
    piece = F.concat(F.when(F.col("gap").isNull(), "").when(F.col("gap") > 15, "   ").otherwise(" "), F.col("word"))
    return placed.withColumn("__p", piece).groupBy(key, "y").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "x1", "word", "__p"))), lambda x: x["__p"]), "").alias("linha")
    )


def ocr_confidence(words: DataFrame, key: str) -> DataFrame:
    """(key, confianca): mean of the page means of word confidences of at least 0, each rounded to one decimal."""
    page = words.where("conf >= 0").groupBy(key, "pagina").agg((F.floor(F.avg("conf") * 10 + 0.5) / 10).alias("m"))
    return page.groupBy(key).agg((F.floor(F.avg("m") * 10 + 0.5) / 10).alias("confianca"))


#: Fixed value: a file with no more text than this is scanned.
SCANNED_CHARS = 50


def scanned(pages: DataFrame, key: str) -> DataFrame:
    """(key, classe): tem_texto or escaneado by the stripped characters of all pages."""
    n = F.sum(F.coalesce(F.length(strip(F.col("texto"))), F.lit(0)))
    return pages.groupBy(key).agg(F.when(n > SCANNED_CHARS, "tem_texto").otherwise("escaneado").alias("classe"))


def metric_columns() -> list[Column]:
    """densidade_texto and proporcao_tabela of a document row: characters a page to one decimal, share of table characters
    to three; 0 where there are none. Table characters are those of Markdown table lines.
    """
    table = F.aggregate(F.filter(F.split(F.coalesce("texto", F.lit("")), "\n"), lambda x: x.rlike(r"^[\s ]*\|[^\n]*\|[\s ]*$")), F.lit(0), lambda a, x: a + F.length(x))
    c, p = F.coalesce("caracteres_extraidos", F.lit(0)).cast("double"), F.coalesce("paginas", F.lit(0))
    density, share = F.floor(F.try_divide(c * 10, p) + 0.5) / 10, F.floor(F.try_divide(table * 1000, c) + 0.5) / 1000
    return [F.coalesce(density, F.lit(0.0)).alias("densidade_texto"), F.coalesce(share, F.lit(0.0)).alias("proporcao_tabela")]


def document_metrics(documents: DataFrame) -> DataFrame:
    """(registro_id, densidade_texto, proporcao_tabela), see metric_columns."""
    return documents.select("registro_id", *metric_columns())
