import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tesselex.functions import pieces as P
from tesselex.operators import chunks


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize("n,overlap,count", [(0, 0, 0), (1, 0, 1), (256, 0, 1), (257, 0, 2), (600, 0, 3), (256, 50, 1), (257, 50, 2), (600, 50, 3), (1000, 50, 5)])
def test_window_count(spark, n, overlap, count):
    got = one(spark, " ".join(["w"] * n), lambda c: P.windows(c, 256, overlap))
    assert len(got) == count == (0 if n == 0 else 1 if n <= 256 else 1 + math.ceil((n - 256) / (256 - overlap)))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet="ab1é§.,- \n\t", max_size=200))
def test_windows_join_to_text(spark, text):
    got = one(spark, text, lambda c: P.windows(c, 7))
    assert "".join(got) == text.rstrip(" \t\n\r\f")


def test_another_tokenizer(spark):
    text = "a decisão, de 12/3:\n\n  segue   o voto\n" * 40
    with P.counted_by(P.BYTE_LEVEL):
        got = one(spark, text, lambda c: P.windows(c, 7))
        n = one(spark, text, P.count)
        df = spark.createDataFrame([(1, "a", "voto", 2020, "v.pdf", text)], "registro_id long, ato_id string, tipo_documento string, ano int, arquivo_origem string, texto string")
        children = chunks.children(df)
    assert "".join(got) == text and n == len(re.findall(r" ?[^\W\d_]+| ?\d+| ?[^\s\w]+|\s+(?!\S)|\s+", text)) and len(got) == math.ceil(n / 7)
    assert children.count() == 1 + math.ceil((n - 256) / 206) != chunks.children(df).count()


def test_article_segments(spark):
    parts = one(spark, "Preâmbulo\nArt. 1º a\n§ 2 b\nCapítulo IV c", lambda c: chunks.named(chunks.segments(c, chunks.ARTICLE_BEGINS), chunks.ARTICLE_NAME))
    assert [(p.contexto, p.texto) for p in parts] == [("", "Preâmbulo"), ("Art. 1º", "Art. 1º a"), ("§ 2", "§ 2 b"), ("Capítulo IV", "Capítulo IV c")]


def test_fitted_starts_afresh(spark):
    line = lambda n, w: " ".join([w] * n)
    got = one(spark, "\n".join([line(200, "a"), line(100, "b"), line(100, "c")]), chunks.fitted)
    assert got == [line(200, "a"), line(100, "b"), line(100, "c")]
    assert one(spark, "x\ny", chunks.fitted) == ["x\ny"]
    assert [len(x.split()) for x in one(spark, line(10, "a") + "\n" + line(600, "b"), chunks.fitted)] == [10, 256, 256, 88]


def test_table_rows(spark):
    head = "| a | b |\n|---|---|"
    rows = [f"| {i} | {'w ' * 100}|" for i in range(6)]
    got = one(spark, head + "\n" + "\n".join(rows), chunks.table_rows)
    assert len(got) == 3 and all(g.startswith(head) for g in got) and sum(g.count("w w") > 0 for g in got) == 3
    assert [r for g in got for r in g.split("\n")[2:]] == rows
    big = "| " + "w " * 300 + "|"
    assert one(spark, big + "\n" + big, chunks.table_rows) == [big + "\n" + big]  # no separator: whole
    assert one(spark, head, chunks.table_rows) == [head]


def test_children_are_numbered_and_linked(spark):
    docs = [(1, "a_1", "voto", 2020, "voto1.pdf", " ".join(f"w{i}" for i in range(700))), (2, "a_2", None, None, "x.pdf", "curto"), (3, "a_3", "anexo", 2020, "y.pdf", "  \n"), (4, "a_4", "outro", 2021, "z.pdf", None), (5, "a_5", "anexo", 2021, "t.pdf", "texto\n| a | b |\n|---|---|\n| 1 | 2 |")]
    df = spark.createDataFrame(docs, "registro_id long, ato_id string, tipo_documento string, ano int, arquivo_origem string, texto string").withColumn("chunk_id", F.lit("clash"))
    got = chunks.children(df.drop("chunk_id")).orderBy("registro_id", "numero_chunk").collect()
    first = [r for r in got if r.registro_id == 1]
    assert [r.chunk_id for r in first] == ["voto1_vo_c001", "voto1_vo_c002", "voto1_vo_c003", "voto1_vo_c004"]
    assert first[0].chunk_anterior_id is None and first[-1].chunk_proximo_id is None and first[1].chunk_anterior_id == first[0].chunk_id
    assert first[1].texto_pai.startswith(first[0].texto) and len(first[1].texto_pai.split()) == 512
    assert {r.registro_id for r in got} == {1, 2, 5}
    assert [(r.contexto_juridico, r.texto) for r in got if r.registro_id == 5] == [("", "texto"), ("[tabela]", "| a | b |\n|---|---|\n| 1 | 2 |")]


def test_caps(spark):
    df = spark.createDataFrame([(1, "a", "anexo", 2020, "a.pdf", " ".join(["w"] * 2000))], "registro_id long, ato_id string, tipo_documento string, ano int, arquivo_origem string, texto string")
    r = chunks.truncated(df, {"anexo": 3}).first()
    assert (r.chunks_gerados, r.chunks_mantidos, r.tokens_totais) == (8, 3, 2000)
    got = chunks.children(df, {"anexo": 3}).collect()
    assert len(got) == 3 and {x.aviso for x in got} == {chunks.TRUNCATED} and {x.total_chunks for x in got} == {3}


def brute_pieces(t):
    return re.findall(r"[ \t\n\r\f]*(?:[^\W]+|[^ \t\n\r\f\w])", t)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 30), min_size=1, max_size=40), st.sampled_from([5, 20]))
def test_packing_is_sound_and_greedy(spark, sizes, size):
    """Stated of the result alone: it keeps every unit in order; a chunk is within the size; no chunk of whole units has room for what the next begins with."""
    texts = [" ".join([f"p{i}"] * n) for i, n in enumerate(sizes)]
    got = one(spark, "\n\n".join(texts), lambda c: chunks.packed(c, size, 1))
    assert " ".join(got).split() == " ".join(texts).split()
    assert all(len(brute_pieces(x)) <= size for x in got)
    whole = {t for t, n in zip(texts, sizes) if n <= size}
    for x, y in zip(got, got[1:]):
        if set(x.split("\n\n")) <= whole and (first := y.split("\n\n")[0]) in whole:
            assert len(brute_pieces(x)) + len(brute_pieces(first)) > size


def test_packed_documents(spark):
    long = " ".join(f"w{i}" for i in range(700))
    rows = [(1, "a1", "voto", 2020, "T1", long), (2, "a2", "texto_integral", 2020, "T2", "\n".join(f"Art. {i} " + "palavra " * 60 for i in range(1, 9))), (3, "a3", "anexo", 2021, "T3", "Cab 1\nCab 2\nCab 3\n" + "x " * 400), (4, "a4", "outro", 2021, None, "curto"), (5, None, None, None, None, None), (6, "a6", "anexo", 2021, "T6", "um dois\n" + "y " * 60)]
    df = spark.createDataFrame(rows, "registro_id long, ato_id string, tipo_documento string, ano int, titulo string, texto string")
    got = chunks.children_packed(df).orderBy("registro_id", "chunk_idx").collect()
    by = {i: [r for r in got if r.registro_id == i] for i in range(1, 7)}
    assert [r.tokens for r in by[1]] == [256, 256, 256, 82] and not by[4] and not by[5]
    assert all(r.texto.startswith("Art.") for r in by[2]) and by[2][0].contexto_juridico == "T2 - Art. 1"
    assert all(r.texto.startswith("Cab 1\nCab 2\nCab 3\n\nx") for r in by[3]) and len(by[3]) == 2
    middle = by[1][1]
    assert middle.texto in middle.texto_pai and middle.texto_pai.startswith("w128 ") and P_COUNT(middle.texto_pai) == 512
    assert [r.tokens for r in chunks.children_packed(df.where("registro_id = 1"), {"voto": 2}).collect()] == [256, 256]


def P_COUNT(t):
    return len(brute_pieces(t))
