import base64
import os
import random

import pytest
from pyspark.sql import functions as F

from tesselex.llm import bpe, packing, tokens

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.VOCABULARY), reason="no vocabulary")
TEXTS = ["", None, "   ", "\n\n", "A tarifa de energia nº 404, R$ 1.234,56!", "<|endoftext|> é texto", "a" * 5000, ".-_" * 700, "👩‍🔧 é ☎ ñandú\r\n\tfim", "it's we'll", "x y z", "0" * 300]


@pytest.fixture(scope="module")
def public():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_public_library(public):
    e = bpe.encoder()
    rng = random.Random(5)
    texts = [t for t in TEXTS if t] + ["".join(rng.choice("ab çãé1 .,\n'") for _ in range(rng.randint(1, 400))) for _ in range(300)]
    for t in texts:
        assert e.encode(t) == public.encode_ordinary(t)


def test_both_merges_agree():
    e, rng = bpe.encoder(), random.Random(9)
    for _ in range(200):
        raw = "".join(rng.choice("abcdeé .-") for _ in range(rng.randint(1, 260))).encode()
        assert bpe.merge_scan(raw, e.ranks) == bpe.merge_heap(raw, e.ranks)


def test_memory_bound_changes_nothing(monkeypatch, public):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    t = "um dois três quatro cinco um dois três"
    assert bpe.Encoder().encode(t) == public.encode_ordinary(t)


def test_encode_ids(spark, public):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)] + [(0, "", "twice")], "doc_id long, text string, ids string")
    got = tokens.encode_ids(df, "doc_id", "text").collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        assert r.ids == (public.encode_ordinary(TEXTS[r.doc_id]) if TEXTS[r.doc_id] else [])
    assert tokens.encode_ids(df.where("false"), "doc_id", "text").count() == 0
    assert tokens.encode_ids(df, "doc_id", "text").schema.simpleString() == "struct<doc_id:bigint,ids:array<int>>"


def test_token_budget_against_counting(spark, public, monkeypatch):
    monkeypatch.setattr(tokens, "HELD_PAIRS", 20)  # tasks hand on early
    rows = [(i, f"c{i % 5}" if i % 7 else None, "x" if i % 3 else None, 2020 + i % 2 if i % 4 else None, TEXTS[i % len(TEXTS)]) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, chunk_id string, piece string, n int, text string").repartition(3)
    got = {(r.piece, r.n): (r.registros, r.tokens) for r in tokens.token_budget(df, {"piece": F.col("piece"), "n": F.col("n")}, "text").collect()}
    want = {}
    for _, _, a, b, t in rows:
        k = want.setdefault((a, b), [0, 0])
        k[0] += 1
        k[1] += len(public.encode_ordinary(t)) if t else 0
    assert got == {k: tuple(v) for k, v in want.items()}
    assert tokens.token_budget(df.where("false"), {"piece": F.col("piece")}, "text").count() == 0


def test_first_of(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None), (5, None)], "row_id long, chunk_id string")
    assert sorted(r.row_id for r in tokens.first_of(df, "chunk_id", "row_id").collect()) == [1, 2, 4, 5]


def test_packing(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice((1, 5, 300, 700, 1300, 2047, 2048, 2049, 5000, 0, None)) if i % 3 else rng.randint(1, 900)) for i in range(900)] + [(None, 4), (1, 7)]
    df = spark.createDataFrame(rows, "item_id long, tamanho int").withColumn("shard", F.lit("clash"))
    got = packing.pack(df, "item_id", "tamanho", 2048, len(rows), 250).toPandas()
    want = sorted((i, n) for i, n in rows if i is not None and n)
    assert sorted(got.groupby("item_id").tamanho.sum().items()) == sorted({i: sum(n for j, n in want if j == i) for i, _ in want}.items())
    used = got.groupby("recipiente").tamanho.sum()
    assert used.max() <= 2048 and (2048 - used).to_dict() == got.groupby("recipiente").livre.first().to_dict()
    sizes = dict(rows)
    whole = got[got.item_id.map(lambda i: (sizes[i] or 0) <= 2048) & (got.item_id != 1)]
    assert (whole.parte == 0).all()
    least = -(-used.sum() // 2048)
    assert len(used) <= least * 1.05 + 8
    assert packing.pack(df.where("false"), "item_id", "tamanho", 2048, 0).count() == 0


def test_sum_of_squares_against_plain_search():
    import numpy as np

    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 41, 300)
    where, bins = packing.sum_of_squares(sizes, 40)
    gaps: list[int] = []
    for i, s in enumerate(sizes.tolist()):
        def cost(g):
            after = gaps.copy()
            if g is None:
                after.append(40 - s)
            else:
                after[after.index(g)] = g - s
            c = {}
            for x in after:
                if x:
                    c[x] = c.get(x, 0) + 1
            return sum(v * v for v in c.values())

        options = [(cost(g), 0, g) for g in sorted({x for x in gaps if x >= s})]
        best = min(options + [(cost(None), 1, 99)]) if s < 40 else (0, 1, 99)
        if best[1]:
            gaps.append(40 - s)
        else:
            gaps[gaps.index(best[2])] = best[2] - s
    used = np.bincount(where, weights=sizes)
    assert bins == len(gaps) and sorted((40 - used).astype(int).tolist()) == sorted(gaps)
