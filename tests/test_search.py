import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesselex.functions.words import STOPWORDS
from tesselex.operators import answers, search

TEXTS = ["tarifa de energia elétrica", "energia energia da usina", "usina hidrelétrica e tarifa social", None, "", "processo administrativo", "energia", "tarifa tarifa tarifa energia"]
ASKED = [(1, "x", "tarifa energia tarifa"), (2, "y", "usina"), (3, "x", "nada aqui"), (4, "z", None)]


def words(t):
    return [w for w in re.sub(r"[^\w]+", " ", (t or "").lower()).split(" ") if len(w) > 2 and w not in STOPWORDS]


def brute_bm25():
    docs = [words(t) for t in TEXTS]
    n, avg = len(docs), sum(map(len, docs)) / len(docs)
    df = Counter(w for d in docs for w in set(d))
    idf = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: x if x >= 0 else 0.25 * mean for w, x in idf.items()}
    out = {}
    for q, _, text in ASKED:
        scores = []
        for i, d in enumerate(docs):
            s = sum(idf.get(w, 0) * d.count(w) * 2.5 / (d.count(w) + 1.5 * (0.25 + 0.75 * len(d) / avg)) for w in words(text))
            if s > 0:
                scores.append((-round(s, 6), i))
        out[q] = [i for _, i in sorted(scores)]
    return out


@pytest.fixture(scope="module")
def tables(spark):
    kinds = ["voto", "texto_integral", "texto_integral", "outro", "voto", "nota_tecnica", "texto_integral", "voto"]
    rows = [(i, t, kinds[i], "ato" if i in (2, 7) else f"ato{i}", f"T{i}", "2020-01-01", None, "ctx", t if i % 2 else "") for i, t in enumerate(TEXTS)]
    chunks = spark.createDataFrame(rows, "row_id long, texto string, tipo_documento string, ato_id string, titulo string, publicacao string, situacao string, contexto_juridico string, texto_pai string")
    return chunks, spark.createDataFrame(ASKED, "pergunta_id long, tipo string, pergunta string")


def test_bm25(tables):
    got = {}
    for r in search.bm25(search.words_of(tables[0]), "row_id", tables[1], "pergunta").orderBy("pergunta_id", "posicao").collect():
        got.setdefault(r.pergunta_id, []).append(r.row_id)
    assert got == {k: v for k, v in brute_bm25().items() if v}


def test_fusion(spark):
    d = spark.createDataFrame([(1, "a", 0), (1, "b", 1)], "pergunta_id long, id string, posicao int")
    s = spark.createDataFrame([(1, "b", 0), (1, "c", 1)], "pergunta_id long, id string, posicao int")
    got = search.fuse(d, s, "id").orderBy("posicao").collect()
    assert [r.id for r in got] == ["b", "a", "c"]
    assert [round(r.escore, 8) for r in got] == [round(x, 8) for x in (0.6 / 62 + 0.4 / 61, 0.6 / 61, 0.4 / 62)]


@pytest.mark.parametrize("few", [True, False])
def test_nearest_both_ways(spark, monkeypatch, few):
    rng = np.random.default_rng(3)
    m = np.round(rng.normal(size=(60, 8)), 1)  # ties happen
    v = spark.createDataFrame([(i, m[i].tolist()) for i in range(60)] + [(99, None)], "vec_id long, e array<double>")
    q = v.where("vec_id % 7 = 0").select(F.col("vec_id").alias("pergunta_id"), F.col("e").alias("vetor"))
    if not few:
        monkeypatch.setattr(search, "BLOCK_QUERIES", 3)
        monkeypatch.setattr(search, "BLOCK_VECTORS", 20)
    got = {(r.pergunta_id, r.posicao): r.vec_id for r in search.nearest(v, "vec_id", "e", q, 5).collect()}
    for i in range(0, 60, 7):
        s = np.floor(m @ m[i] * 1e6 + 0.5) / 1e6
        assert [got[i, k] for k in range(5)] == np.lexsort((np.arange(60), -s))[:5].tolist()


def test_expansion_modes(spark):
    chunks = spark.createDataFrame([(i, "voto", "a1") for i in range(5)] + [(7, "texto_integral", "a1"), (9, "texto_integral", "a1")], "row_id long, tipo_documento string, ato_id string")
    ranked = spark.createDataFrame([(1, i, "a1", "voto", 1.0, 1.0 - i / 10, i) for i in range(5)], "pergunta_id long, row_id long, ato_id string, tipo_documento string, bruto double, escore double, posicao int")
    ids = lambda df: [r.row_id for r in df.orderBy("posicao").collect()]
    assert ids(search.expand(ranked, chunks, "row_id")) == [0, 1, 2, 3, 4]
    assert ids(search.expand(ranked, chunks, "row_id", "reserve")) == [0, 1, 2, 3, 7]
    assert ids(search.expand(ranked.where("posicao < 2"), chunks, "row_id")) == [0, 1, 7]


def test_hybrid_filter_and_prompts(tables, spark):
    chunks, questions = tables
    got = search.hybrid(chunks, questions, kinds=["voto"], filter_sparse=True)
    assert {r.tipo_documento for r in got.where("escore > 0").collect()} <= {"voto"}
    blocks = answers.context_blocks(search.hybrid(chunks, questions), chunks, "row_id")
    said = {r.pergunta_id: r.mensagens for r in answers.messages(blocks, questions).collect()}
    assert set(said) == {1, 2, 3, 4} and said[1][0].role == "system" and "DOCUMENTO 1" in said[1][1].content
    empty = answers.messages(blocks.where("false"), questions).first()
    assert empty.mensagens[1].content == answers.NOTHING_FOUND


def test_at_most_per_document(spark):
    df = spark.createDataFrame([(1, i, "a" if i < 4 else None) for i in range(7)], "pergunta_id long, posicao int, ato_id string")
    assert sorted(r.posicao for r in search.at_most_per_document(df, ["ato_id"]).collect()) == [0, 1, 4, 5]


def test_sample_is_stable(tables):
    assert [r.pergunta_id for r in answers.sample(tables[1], 2).collect()] == [r.pergunta_id for r in answers.sample(tables[1].repartition(3), 2).collect()]


def test_variant(tables):
    chunks, questions = tables
    chunks = chunks.withColumn("arquivo_origem", F.lit("um.pdf"))
    got = search.hybrid_variant(chunks, questions)
    assert got.groupBy("pergunta_id").count().agg(F.max("count")).first()[0] <= 5
    plain = search.hybrid_variant(chunks, questions, use_reranking=False, use_expansion=False, final=2).collect()
    assert all(r.bruto == r.escore and r.posicao < 2 for r in plain)


def test_generators(spark, tables):
    prompts = answers.messages(spark.createDataFrame([(1, 0, "bloco")], "pergunta_id long, posicao int, bloco string"), tables[1])

    def good(said):
        return said[1]["content"][:10]

    def bad(said):
        raise RuntimeError("limite")

    got = {(r.pergunta_id, r.modelo): (r.resposta, r.erro) for r in answers.compared(prompts, {"a": good, "b": bad}).collect()}
    assert len(got) == 8 and got[1, "a"] == ("DOCUMENTOS", None) and got[1, "b"] == (None, "limite")
