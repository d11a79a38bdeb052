import random
import re

import numpy as np
import pytest

from tesselex.llm import near_dup as N

VOCAB = [f"w{i}" for i in range(4000)]


def edited(words, rng, share):
    out = list(words)
    for _ in range(max(1, int(len(out) * share))):
        k = rng.random()
        at = rng.randrange(len(out))
        if k < 0.4:
            out[at] = rng.choice(VOCAB)
        elif k < 0.7:
            out.insert(at, rng.choice(VOCAB))
        else:
            del out[at]
    return out


def shingle_set(t):
    w = re.findall(r"[^\W_]+", (t or "").lower())
    return frozenset(zip(w, w[1:], w[2:])) if len(w) >= 20 else None


def brute(rows):
    s = [(i, x) for i, t in rows if (x := shingle_set(t))]
    return {(min(a, b), max(a, b)) for k, (a, x) in enumerate(s) for b, y in s[:k] if len(x & y) / len(x | y) >= N.SIMILARITY}


def corpus(seed=0, families=40):
    rng = random.Random(seed)
    rows, i = [], 0
    for f in range(families):
        base = [rng.choice(VOCAB) for _ in range(rng.choice((19, 20, 25, 60, 200, 600)))]
        for v in range(rng.randint(1, 4)):
            t = " ".join(base if v == 0 or rng.random() < 0.3 else edited(base, rng, rng.choice((0.01, 0.04, 0.08))))
            rows.append((i, t.upper() if rng.random() < 0.2 else t + "  !"))
            i += 1
    return rows + [(i, None), (i + 1, ""), (i + 2, "  \n"), (i + 3, "x_y " * 30)]


def test_pairs_against_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "registro_id long, texto string, rep string").selectExpr("*", "1 id", "2 a", "3 b", "4 key").repartition(4)
    got = [(r.registro_id_a, r.registro_id_b) for r in N.pairs(df, "registro_id", "texto").collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)
    groups = {r.registro_id: r for r in N.groups(df, "registro_id", "texto").collect()}
    assert set(groups) == {i for i, _ in rows}
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute(rows):
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    assert {i: r.grupo for i, r in groups.items()} == {i: root(i) for i, _ in rows}


def test_empty_table(spark):
    df = spark.createDataFrame([], "registro_id long, texto string")
    assert N.pairs(df, "registro_id", "texto").count() == 0 and N.groups(df, "registro_id", "texto").count() == 0


def test_hot_cells_in_blocks(spark):
    rng = random.Random(4)
    base = [rng.choice(VOCAB) for _ in range(300)]
    rows = [(i, " ".join(edited(base, rng, rng.choice((0.01, 0.05, 0.12))))) for i in range(120)] + [(200 + i, " ".join(rng.choice(VOCAB) for _ in range(100))) for i in range(20)]
    df = spark.createDataFrame(rows, "registro_id long, texto string").repartition(4)
    reps, _ = N.classes(df, "registro_id", "texto")
    plain = {(r.a, r.b) for r in N.candidates(reps).collect()}
    hot = {(r.a, r.b) for r in N.candidates(reps, hot_rows=10, block_rows=16).collect()}
    true = brute(rows)
    assert plain == hot and len(true) > 1000
    assert len(true - plain) <= 0.002 * len(true)  # most of these lie just above the threshold


@pytest.mark.parametrize("n", [2, 40, 700])
def test_tree_finds_all_close_pairs(n):
    rng = np.random.default_rng(n)
    centres = rng.integers(0, 1 << 63, (max(1, n // 20), 4)).astype(np.uint64)
    prints = centres[rng.integers(0, len(centres), n)].copy()
    for _ in range(30):
        prints[np.arange(n), rng.integers(0, 4, n)] ^= np.uint64(1) << rng.integers(0, 63, n).astype(np.uint64)
    reach = rng.integers(10, 70, n)
    a, b = N.close_pairs(prints, reach)
    got = sorted((min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist()))
    d = np.bitwise_count(prints[:, None] ^ prints[None]).sum(-1)
    want = [(i, j) for i in range(n) for j in range(i + 1, n) if d[i, j] <= max(reach[i], reach[j])]
    assert got == want


def test_gaps_prune_branches(monkeypatch):
    """A cell of many tight families: sides of a gap wider than the reach are never compared."""
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, (40, 4)).astype(np.uint64)
    family = rng.integers(0, 40, 4000)
    prints = centres[family].copy()
    for _ in range(10):
        prints[np.arange(4000), rng.integers(0, 4, 4000)] ^= np.uint64(1) << rng.integers(0, 63, 4000).astype(np.uint64)
    compared = 0
    far = N._far

    def counting(a, b):
        nonlocal compared
        d = far(a, b)
        compared += d.size
        return d

    monkeypatch.setattr(N, "_far", counting)
    a, b = N.close_pairs(prints, np.full(4000, 62))
    assert len(a) == sum(int(n) * (int(n) - 1) // 2 for n in np.bincount(family))
    assert compared < 0.12 * 4000 * 3999 / 2, compared  # the pairs of a family are 0.025 of all


def test_equal_prints_do_not_hang():
    prints = np.zeros((3000, 4), np.uint64)
    a, b = N.close_pairs(prints, np.full(3000, 5))
    assert len(a) == 3000 * 2999 // 2


def test_recall_at_the_threshold():
    """Pairs between 0.70 and 0.75: bands and reach together keep nearly all."""
    rng, known = random.Random(8), N._Words()
    kept = total = 0
    while total < 400:
        base = [rng.choice(VOCAB) for _ in range(rng.choice((30, 100, 400)))]
        x, y = N.shingles(" ".join(base), known), N.shingles(" ".join(edited(base, rng, rng.uniform(0.04, 0.1))), known)
        if x is None or y is None:
            continue
        j = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        if 0.70 <= j < 0.75:
            total += 1
            _, prints, keys, sizes = N.sketch([x, y])
            reach = N.radius(sizes)
            kept += bool((keys[0] == keys[1]).any()) and int(np.bitwise_count(prints[0] ^ prints[1]).sum()) <= reach.max()
    print("recall", kept / total)
    assert kept / total >= 0.99
