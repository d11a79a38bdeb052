import pytest
from pyspark.sql import functions as F

from tesselex.operators import answers, chunks, search

CHUNK = "row_id long, ato_id string, tipo_documento string, titulo string, ementa string, situacao string, publicacao string, contexto_juridico string, texto string, texto_pai string"


@pytest.fixture(scope="module")
def tables(spark):
    rows = [
        (1, "a1", "voto", "T" * 120, None, None, "2020-01-01", "Art. 1", "tarifa de energia", "tarifa de energia da usina"),
        (2, None, None, None, "E", "revogado", None, None, "contrato", ""),
    ]
    questions = [(1, "fato", "Qual tarifa energia?", None), (2, "lista", "Como contrato?", "ref"), (3, "fato", "nada achado", None), (4, None, None, None)]
    found = [(1, 1, 0, 0.9), (1, 2, 1, 0.5), (2, 2, 0, 0.7)]
    return (
        spark.createDataFrame(rows, CHUNK),
        spark.createDataFrame(questions, "pergunta_id int, tipo string, pergunta string, resposta_ref string"),
        spark.createDataFrame(found, "pergunta_id int, row_id long, posicao int, escore double"),
    )


@pytest.fixture
def echo():
    def said_again(said):  # defined here, so that workers need not import this file
        asked = said[-1]["content"].split("PERGUNTA: ")[-1]
        if asked.startswith("Como"):
            raise ValueError("sem modelo")
        return "a tarifa da usina"

    return said_again


def test_benchmark_keeps_errors_and_questions_without_results(tables, echo):
    c, q, found = tables
    got = {r.pergunta_id: r for r in answers.benchmark(c, found, q, echo, "m").collect()}
    assert set(got) == {1, 2, 3, 4} and {r.modelo for r in got.values()} == {"m"}
    assert [(x.ato_id, x.escore) for x in got[1].fontes] == [("a1", 0.9), (None, 0.5)] and got[1].contextos == ["tarifa de energia da usina", "contrato"]
    assert len(got[1].fontes[0].titulo) == 100 and got[1].resposta == "a tarifa da usina" and got[1].erro is None
    assert got[2].resposta is None and got[2].erro == "sem modelo" and len(got[2].fontes) == 1
    for i in (3, 4):
        assert got[i].resposta == answers.NOTHING_FOUND and got[i].erro is None and got[i].fontes == [] and got[i].contextos == []
    empty = found.where("false")
    assert {r.resposta for r in answers.benchmark(c, empty, q, echo, "m").collect()} == {answers.NOTHING_FOUND}
    assert answers.benchmark(c, found, q.where("false"), echo, "m").count() == 0


def test_metrics_of_results(tables, echo):
    c, q, found = tables
    got = {r.pergunta_id: (r.fidelidade, r.relevancia, r.precisao) for r in answers.result_metrics(answers.benchmark(c, found, q, echo, "m")).collect()}
    assert set(got) == {1, 3, 4}  # the row with an error is left out
    assert got[1] == (1.0, 0.333, 0.5)  # tarifa, usina; tarifa of qual, tarifa, energia; one of two contexts
    assert got[4] == (0.0, 0.0, 0.0)


def test_rich_blocks_leave_out_empty_fields(tables):
    c, _, found = tables
    got = {(r.pergunta_id, r.posicao): r.bloco for r in answers.context_blocks(found, c, "row_id", rich=True).collect()}
    assert "Ementa" not in got[1, 0] and "Localização: Art. 1\n\nTRECHO:\ntarifa de energia da usina\n" in got[1, 0]
    assert "Ementa: E" in got[1, 1] and "Localização" not in got[1, 1] and "Tipo: \nAto: \n" in got[1, 1] and got[1, 1].endswith("TRECHO:\ncontrato\n")


def test_vectors_of_words(spark):
    df = spark.createDataFrame([(1, ["energia", "tarifa", "energia"]), (2, []), (3, ["energia"]), (4, ["tarifa"])], "k long, w array<string>")
    v = {r.k: r.vetor for r in search.embedded(df, "k").collect()}
    assert v[2] == [0.0] * search.DIMENSIONS and all(abs(sum(x * x for x in v[i]) - 1) < 1e-12 for i in (1, 3, 4))
    mixed = [2 * a + b for a, b in zip(v[3], v[4])]
    n = sum(x * x for x in mixed) ** 0.5
    assert all(abs(a - b / n) < 1e-12 for a, b in zip(v[1], mixed))


def test_row_numbers(spark):
    df = spark.createDataFrame([(i, f"c{i * 7919 % 1000:04d}", "2020", None) for i in range(500)] + [(900, "c0000", None, "x"), (901, None, "abc", "x"), (902, None, None, None)], "row_id long, chunk_id string, ano string, tipo_documento string")
    got = chunks.index_rows(df.repartition(5).withColumn("linha", F.lit("clash"))).orderBy("linha").collect()
    assert [r.linha for r in got] == list(range(501)) and got[0].chunk_id is None and got[0].row_id == 901
    assert [r.chunk_id for r in got[1:]] == sorted(f"c{i * 7919 % 1000:04d}" for i in range(500)) and got[1].row_id == 0
    assert chunks.index_rows(df.where("false")).count() == 0
