from pyspark.sql import functions as F

from tesselex.functions import cleaning as C
from tesselex.operators import pages


def one_row(spark, **columns):
    return spark.createDataFrame([(1, *columns.values())], ", ".join(["id long", *[f"{c} array<string>" if isinstance(v, list) else f"{c} string" for c, v in columns.items()]]))


def test_repeated_lines_threshold(spark):
    texts = [("CABECALHO\n" if i < 3 else "") + f"linha {i} unica\ncorpo\nmeio {i}\nfim {i} aqui" + ("\nRODAPE X" if i < 2 else "") for i in range(10)]
    rows = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "id long, pagina int, texto string").repartition(3)
    for df in (one_row(spark, p=texts).withColumn("paginas", F.col("p")), pages.by_document(rows, "id")):
        assert {(r.linha, r.paginas) for r in pages.repeated_lines(df, "id", F.col("paginas")).collect()} == {("CABECALHO", 3)}
    two = one_row(spark, p=["igual aqui\nx", "igual aqui\ny"])
    assert [(r.linha, r.paginas) for r in pages.repeated_lines(two, "id", F.col("p")).collect()] == [("igual aqui", 2)]
    assert pages.repeated_lines(one_row(spark, p=["igual aqui"]), "id", F.col("p")).count() == 0
    assert pages.repeated_lines(one_row(spark, p=[]), "id", F.col("p")).count() == 0


def test_validity(spark):
    df = spark.createDataFrame([(1, 0, "-" * 49), (1, 1, "a" * 54 + "-" * 46), (1, 2, "a" * 55 + "-" * 45), (2, 0, "")], "id long, pagina int, texto string")
    got = {(r.id, r.pagina): (r.suspeita, r.razao_alfa) for r in pages.validity(df, "id").collect()}
    assert got == {(1, 0): (False, 1000), (1, 1): (True, 540), (1, 2): (False, 550), (2, 0): (False, 1000)}


def laid_out(spark, text, patterns=()):
    return pages.laid_out(one_row(spark, t=text.split("\n"), p=list(patterns)), "id", F.col("t"), F.col("p")).first()


def test_layout_needs_four_lines(spark):
    row = lambda i: f"coluna{i}     valor{i}     total{i}"
    text = "antes\n" + "\n".join(map(row, range(3))) + "\nmeio\n" + "\n".join(map(row, range(4))) + "\ndepois"
    r = laid_out(spark, text)
    assert r.tabelas == 1
    parts = r.texto.split("\n\n")
    assert parts[0] == "antes" and parts[1].endswith("meio") and parts[1].startswith("coluna0 valor0 total0")
    assert parts[2].split("\n")[:2] == ["| coluna0 | valor0 | total0 |", "| --- | --- | --- |"] and parts[3] == "depois"
    assert r.chars_tabela == len(parts[2]) and r.removidos == 0
    assert laid_out(spark, "\n".join(map(row, range(3)))).texto.split("\n")[0] == "coluna0 valor0 total0"  # a short run that ends the page


def test_layout_leaves_out_repeated_lines(spark):
    r = laid_out(spark, "AGENCIA X\ncorpo da página\nPágina 3 de 9\nfim", ["AGENCIA X"])
    assert r.texto == "corpo da página\n\nfim" and r.removidos == len("Página 3 de 9") + len("AGENCIA X") + 1


def test_rollup_and_words(spark):
    docs = spark.createDataFrame([(1, "\n".join(map(str, range(25)))), (2, "")], "id long, texto string")
    got = {r.id: r for r in pages.rollup(docs, "id", pages.page_array(F.col("texto"))).collect()}
    assert {(i, r.paginas) for i, r in got.items()} == {(1, 3), (2, 1)} and got[2].texto == "" and got[2].caracteres == 0
    rows = pages.pages_of(docs, "id", "texto")
    again = {r.id: r for r in pages.rollup(pages.by_document(rows, "id"), "id", F.col("paginas")).collect()}
    assert again == got
    words = spark.createDataFrame([(1, 0.0, 10.0, 1.0, "a"), (1, 12.0, 20.0, 2.0, "b"), (1, 50.0, 60.0, 2.4, "c"), (1, 0.0, 9.0, 7.6, "d")], "id long, x0 double, x1 double, y0 double, word string")
    assert [r.linha for r in pages.layout_lines(words, "id").orderBy("y").collect()] == ["a b   c", "d"]


def test_no_text_is_shuffled(spark):
    df = one_row(spark, t="a\nb")
    array = pages.page_array(F.col("t"))
    for out in (pages.cleaned(df, "id", "t", array), pages.rollup(df, "id", array), pages.laid_out(df, "id", F.split("t", "\n"), pages.patterns_of(array))):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_entities(spark):
    html = "<p>A&ccedil;&atilde;o n&ordm; 1 &amp;lt; &#233; &#xE9; &Eacute; &nada; a & b &#1114112; &#55296; &euro;</p>"
    got = spark.createDataFrame([(html,)], "h string").select(C.html_text(F.col("h"))).first()[0]
    assert got == "Ação nº 1 &lt; é é É &nada; a & b &#1114112; &#55296; €"
    page = "<header>Topo</header><p>Página 2 de 9 fim</p><script>x</script><p>b</p>"
    one = spark.createDataFrame([(page,)], "h string").select(C.html_text(F.col("h")), C.html_text_plain(F.col("h"))).first()
    assert one[0] == "fim\n\nb" and one[1] == "Topo fim b"


def test_ocr_confidence(spark):
    df = spark.createDataFrame([(1, 0, 90.0), (1, 0, 80.0), (1, 0, -1.0), (1, 1, 50.0)], "id long, pagina int, conf double")
    assert pages.ocr_confidence(df, "id").first().confianca == 67.5


def test_table_blocks(spark):
    t = "a\n| x | y |\n|---|---|\n\n\nb\n| z |"
    got = [(r.tabela, r.bloco) for r in pages.table_blocks(spark.createDataFrame([(1, t), (2, None)], "id long, t string"), "id", "t").orderBy("ordem").collect()]
    assert got == [(False, "a"), (True, "| x | y |\n|---|---|"), (False, "b"), (True, "| z |")]
