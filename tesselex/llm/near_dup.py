"""Near-duplicate records over word shingles.

Every text gets a fingerprint of 256 bits, one bit of each of 256 minhash slots, so that Hamming distance follows the
Jaccard similarity. Over all fingerprints at once a vantage-point tree prunes nothing at this similarity (see README), so
candidates come from bands: two texts of the similarity sought agree in all slots of some band, and rows of one band key
form a cell. A cell of more than LEAF rows is partitioned by vantage points: where a gap in the distances is wider than the
reach the two sides never meet, otherwise only what the triangle inequality leaves within reach of the boundary does. Cells
beyond HOT_ROWS are cut along distances from their vantage point into blocks, and block pairs out of reach are pruned before
anything is sent. The pairs left are verified exactly on the texts. Exact copies are one class from the start.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselex.plans.lineage import written

WORDS = 3
LEAST_WORDS = 20
SIMILARITY = 0.7
SLOTS = 256
BANDS, BAND_SLOTS = 64, 6
#: Bits of slack of a fingerprint's distance, in standard deviations.
SLACK = 4.0
LEAF = 16
HOT_ROWS = 4096
BLOCK_ROWS = 2048
STEP = 256
_WORD = re.compile(r"[^\W_]+")
_U = np.uint64
_P1, _P2, _P3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_rng = np.random.default_rng(20240)
_PROBE = _rng.integers(0, SLOTS, (64, SLOTS))
_SALT = _rng.integers(1, 1 << 62, SLOTS).astype(np.uint64)
_COLUMNS = np.stack([_rng.choice(SLOTS, BAND_SLOTS, replace=False) for _ in range(BANDS)])


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _P2
    x = (x ^ (x >> _U(27))) * _P3
    return x ^ (x >> _U(31))


class _Words(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) > 400_000:
            self.clear()
        self[word] = h
        return h


def shingles(text: str | None, known: _Words, words: int = WORDS, least: int = LEAST_WORDS) -> np.ndarray | None:
    """Sorted distinct 64-bit hashes of the successive words of a text; None if it has fewer than `least` words."""
    if not text:
        return None
    found = _WORD.findall(text.lower())
    if len(found) < max(least, words):
        return None
    w = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    n = len(w) - words + 1
    h = w[:n].copy()
    for k in range(1, words):
        h = _mix(h * _P1 + w[k : n + k])
    return np.unique(_mix(h))


def sketch(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(class hashes D x 2, fingerprints D x 4, band keys D x BANDS, sizes) of shingle sets. Empty slots are filled from
    others by a fixed probing order, the same for all texts.
    """
    d = len(sets)
    slots, full = np.zeros((d, SLOTS), np.uint64), np.zeros((d, SLOTS), bool)
    own = np.empty((d, 2), np.uint64)
    for i, h in enumerate(sets):
        b = (h >> _U(56)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(b[1:] != b[:-1]) + 1))
        slots[i, b[first]] = h[first]
        full[i, b[first]] = True
        own[i] = np.bitwise_xor.reduce(_mix(h)), np.add.reduce(_mix(h ^ _P1))
    r, c = np.nonzero(~full)
    for probe in _PROBE:
        if not len(r):
            break
        src = probe[c]
        ok = full[r, src]
        slots[r[ok], c[ok]] = slots[r[ok], src[ok]]
        r, c = r[~ok], c[~ok]
    if len(r):
        slots[r, c] = np.array([sets[i][0] for i in r.tolist()], np.uint64)
    bits = (_mix(slots ^ _SALT) & _U(1)).astype(np.uint8)
    prints = np.packbits(bits, axis=1).view(np.uint64)
    keys = np.empty((d, BANDS), np.uint64)
    for k, columns in enumerate(_COLUMNS):
        acc = np.full(d, k + 1, np.uint64)
        for x in columns:
            acc = _mix(acc * _P1 + slots[:, x])
        keys[:, k] = acc
    return own, prints, keys, np.array([len(h) for h in sets], np.int32)


def radius(sizes: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The Hamming distance within which a partner of a set of this size lies, SLACK standard deviations over the mean. Few
    shingles fill few slots of their own, which widens it.
    """
    p = (1 - similarity) / 2
    own = SLOTS * (1 - np.exp(-np.maximum(sizes, 1) / SLOTS))
    return np.minimum(SLOTS, np.ceil(SLOTS * (p + SLACK * np.sqrt(p * (1 - p) / own)))).astype(np.int64)


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def _between(prints: np.ndarray, reach: np.ndarray, a: np.ndarray, b: np.ndarray, out: list) -> None:
    """All pairs of the disjoint index sets a and b within reach, in blocks."""
    for i in range(0, len(a), 512):
        x = a[i : i + 512]
        for j in range(0, len(b), 1024):
            y = b[j : j + 1024]
            ok = _far(prints[x][:, None], prints[y][None]) <= np.maximum(reach[x][:, None], reach[y][None])
            p, q = np.nonzero(ok)
            out.append((x[p], y[q]))


def _cross(prints: np.ndarray, reach: np.ndarray, a: np.ndarray, b: np.ndarray, out: list) -> None:
    """Pairs between two subtrees: split both about one vantage point and follow only halves the triangle inequality lets meet."""
    if not len(a) or not len(b):
        return
    if len(a) * len(b) <= LEAF * LEAF * 4:
        _between(prints, reach, a, b, out)
        return
    v = a[0]
    da, db = _far(prints[a], prints[v]), _far(prints[b], prints[v])
    most = int(max(reach[a].max(), reach[b].max()))
    mid = int(np.median(da))
    near, far = da <= mid, da > mid
    left = [(a[near], b[db <= mid + most])]
    if far.any():
        left.append((a[far], b[db >= int(da[far].min()) - most]))
    if sum(len(x) * len(y) for x, y in left) > 0.8 * len(a) * len(b):
        _between(prints, reach, a, b, out)  # nothing to prune here
        return
    for x, y in left:
        _cross(prints, reach, x, y, out)


def close_pairs(prints: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j), each once, whose distance is within the larger reach of the two, by a vantage-point tree.

    A node is split at the widest gap in the distances from its vantage point if that gap exceeds the reach, which no pair
    can cross; else at the median, and the halves are searched against each other where the triangle inequality lets them meet.
    """
    out: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [np.arange(len(prints))]
    while todo:
        at = todo.pop()
        if len(at) <= LEAF:
            if len(at) > 1:
                i, j = np.triu_indices(len(at), 1)
                x, y = at[i], at[j]
                ok = _far(prints[x], prints[y]) <= np.maximum(reach[x], reach[y])
                out.append((x[ok], y[ok]))
            continue
        d = _far(prints[at], prints[at[0]])
        most = int(reach[at].max())
        lengths = np.unique(d)
        gaps = np.diff(lengths)
        if len(gaps) and gaps.max() > most:
            inside = d <= lengths[int(gaps.argmax())]
            todo += [at[inside], at[~inside]]
            continue
        mid = int(np.median(d))
        inner, outer = at[d <= mid], at[d > mid]
        if not len(outer):  # more than half at one distance: cut by order instead
            inner, outer = at[: len(at) // 2], at[len(at) // 2 :]
            _cross(prints, reach, inner, outer, out)
        else:
            di, do = d[d <= mid], d[d > mid]
            _cross(prints, reach, inner[di >= int(do.min()) - most], outer[do <= int(di.max()) + most], out)
        todo += [inner, outer]
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


_PRINT = ["f0", "f1", "f2", "f3"]
_SKETCH = "id long, n int, c1 long, c2 long, f0 long, f1 long, f2 long, f3 long, bands array<long>"


def sketches(df: DataFrame, key: str, text: str) -> DataFrame:
    """A sketch of every row that has LEAST_WORDS words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                rows = [(i, s) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) if (s := shingles(t, known)) is not None]
                if not rows:
                    continue
                own, prints, keys, sizes = sketch([s for _, s in rows])
                long = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), long(keys.ravel()))
                cols = [pa.array([i for i, _ in rows], pa.int64()), pa.array(sizes), *[long(own[:, k]) for k in range(2)], *[long(prints[:, k]) for k in range(4)], bands]
                yield pa.RecordBatch.from_arrays(cols, ["id", "n", "c1", "c2", *_PRINT, "bands"])

    return df.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, _SKETCH)


def _in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Close pairs of each run of equal (cell, side): rows come sorted by cell. side 0 takes all pairs of the run,
    otherwise pairs between sides 1 and 2.
    """
    rest: list[np.ndarray] | None = None

    def done(cols: list[np.ndarray]) -> pa.RecordBatch:
        cell, ids, n, side = cols[:4]
        prints = np.stack(cols[4:], 1).view(np.uint64)
        reach = radius(n)
        edge = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
        size = np.diff(edge)
        two = edge[:-1][size == 2]
        near = _far(prints[two], prints[two + 1]) <= np.maximum(reach[two], reach[two + 1])
        ok = near & ((side[two] == 0) | (side[two] != side[two + 1]))
        x, y, at = [ids[two[ok]]], [ids[two[ok] + 1]], [cell[two[ok]]]
        for s, k in zip(edge[:-1][size > 2].tolist(), size[size > 2].tolist()):
            own = slice(s, s + k)
            if side[s] == 0:
                i, j = close_pairs(prints[own], reach[own])
            else:
                out: list[tuple[np.ndarray, np.ndarray]] = []
                sd = side[own]
                _cross(prints[own], reach[own], np.flatnonzero(sd == 1), np.flatnonzero(sd == 2), out)
                i, j = (np.concatenate([p for p, _ in out]), np.concatenate([q for _, q in out])) if out else (np.empty(0, np.int64), np.empty(0, np.int64))
            x.append(ids[own][i])
            y.append(ids[own][j])
            at.append(np.full(len(i), cell[s]))
        a, b, c = np.concatenate(x), np.concatenate(y), np.concatenate(at)
        ok = a != b
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[ok]), pa.array(np.maximum(a, b)[ok]), pa.array(c[ok])], ["a", "b", "cell"])

    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            cols = [np.concatenate((p, q)) for p, q in zip(rest, cols)]
        if not len(cols[0]):
            continue
        last = int(np.searchsorted(cols[0], cols[0][-1], "left"))  # the last cell may go on in the next batch
        if last:
            yield done([c[:last] for c in cols])
        rest = [c[last:] for c in cols]
    if rest is not None and len(rest[0]):
        yield done(rest)


def _searched(cells: DataFrame) -> DataFrame:
    """Pairs from rows (cell, id, n, side, f0..f3), cells being of bounded size."""
    rows = cells.select("cell", "id", "n", "side", *_PRINT)
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(_in_cells, "a long, b long, cell long")


def _reach_of(n: Column) -> Column:
    """`radius` of a set's size as a column."""
    p = (1 - SIMILARITY) / 2
    own = SLOTS * (1 - F.exp(-F.greatest(n, F.lit(1)) / SLOTS))
    return F.least(F.lit(float(SLOTS)), F.ceil(SLOTS * (p + SLACK * F.sqrt(p * (1 - p) / own))))


def _blocks(hot: DataFrame, block_rows: int) -> DataFrame:
    """Rows of hot cells (key, id, n, f0..f3) as cells of two blocks or one. A cell's rows are ordered by distance from its
    vantage point (the row of lowest id) and cut into blocks; blocks farther apart than the reach are not paired.
    """
    far = lambda p, q: sum((F.bit_count(F.col(f"{p}.{f}").bitwiseXOR(F.col(f"{q}.{f}"))) for f in _PRINT), F.lit(0))
    point = hot.groupBy("key").agg(F.min_by(F.struct(*_PRINT), "id").alias("v"))
    rows = hot.join(point, "key").withColumn("f", F.struct(*_PRINT)).withColumn("d", far("f", "v").cast("int"))
    # how many rows lie at each distance: at most SLOTS + 1 counts a cell, so the order needs no sort of the cell
    ring = rows.groupBy("key", "d").agg(F.count("*").alias("k"))
    before = F.coalesce(F.sum("k").over(Window.partitionBy("key").orderBy("d").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ring = ring.select("key", "d", F.ceil(F.col("k") / block_rows).cast("int").alias("parts"), F.floor(before / block_rows).cast("long").alias("base"))
    # a ring too large for a block is spread by a hash, smaller ones share the block they begin in
    own = F.when(
        F.col("parts") > 1, F.concat(F.lit("d"), F.col("d"), F.lit(":"), F.pmod(F.xxhash64("id"), F.col("parts")))
    ).otherwise(F.concat(F.lit("b"), F.col("base")))
    placed = written(rows.join(ring, ["key", "d"]).withColumn("block", own).select("key", "id", "n", "d", "block", *_PRINT), "hot-blocks")
    span = placed.groupBy("key", "block").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.min("n").alias("n"))
    x, y = (span.select("key", *[F.col(c).alias(f"{c}{i}") for c in ("block", "lo", "hi", "n")]) for i in (1, 2))
    apart = F.greatest(F.col("lo2") - F.col("hi1"), F.col("lo1") - F.col("hi2"))
    pairs = x.join(y, "key").where((F.col("block1") <= F.col("block2")) & (apart <= _reach_of(F.least("n1", "n2"))))
    end = lambda block, side: F.struct(F.col(block).alias("block"), F.lit(side).alias("side"))
    both = F.when(F.col("block1") == F.col("block2"), F.array(end("block1", 0))).otherwise(F.array(end("block1", 1), end("block2", 2)))
    ends = pairs.select("key", F.xxhash64("key", "block1", "block2").alias("cell"), F.explode(both).alias("e")).select("key", "cell", "e.block", "e.side")
    return placed.join(ends, ["key", "block"]).select("cell", "id", "n", "side", *_PRINT)


def candidates(reps: DataFrame, hot_rows: int = HOT_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b, cell), a < b: pairs of sketched rows that share a band and lie within reach of each other, and the lowest of
    the cells that found them.
    """
    bands = reps.select("id", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("k")).where("k > 1")
    members = bands.join(shared, "key")
    cells = written(members.join(reps.select("id", "n", *_PRINT), "id").select("key", "k", "id", "n", *_PRINT), "cells")
    found = _searched(cells.where(F.col("k") <= hot_rows).select(F.col("key").alias("cell"), "id", "n", F.lit(0).alias("side"), *_PRINT))
    hot = cells.where(F.col("k") > hot_rows)
    if not hot.isEmpty():
        found = found.unionByName(_searched(_blocks(hot.drop("k"), block_rows)))
    return found.groupBy("a", "b").agg(F.min("cell").alias("cell"))


def _verify(similarity: float):
    """Reads rows (cell, kind, a, b, t) sorted by cell and kind: first the texts of a cell (kind 0, a the row), then its pairs (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        now, sets = None, {}
        for batch in batches:
            out = []
            for cell, kind, a, b, t in zip(*[c.to_pylist() for c in batch.columns]):
                if cell != now:
                    now, sets = cell, {}
                if kind == 0:
                    sets[a] = shingles(t, known)
                    continue
                x, y = sets[a], sets[b]
                both = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
                j = both / (len(x) + len(y) - both)
                if j >= similarity:
                    out.append((a, b, j))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["a", "b", "similaridade"])

    return run


def verified(pairs: DataFrame, df: DataFrame, key: str, text: str, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b, similaridade) of the pairs (a, b, cell) that reach the similarity, on the shingles of the texts themselves. A
    text goes once to each cell that has a pair of it, not once to each pair.
    """
    texts = df.select(F.col(key).cast("long").alias("a"), F.col(text).cast("string").alias("t"))
    needed = pairs.select("cell", F.explode(F.array("a", "b")).alias("a")).distinct()
    rows = needed.join(texts, "a").select("cell", F.lit(0).alias("kind"), "a", F.lit(None).cast("long").alias("b"), "t")
    both = rows.unionByName(pairs.select("cell", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("string").alias("t")))
    return both.repartition("cell").sortWithinPartitions("cell", "kind").mapInArrow(_verify(similarity), "a long, b long, similaridade double")


def classes(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(sketches of one row per set of shingles, the row of lowest key; (id, rep) of all sketched rows)."""
    all_of = written(sketches(df, key, text), "sketches")
    lowest = all_of.groupBy("c1", "c2").agg(F.min("id").alias("rep"))
    member = written(all_of.select("id", "c1", "c2").join(lowest, ["c1", "c2"]).select("id", "rep"), "members")
    reps = all_of.join(member.where("id = rep").select("id"), "id", "left_semi")
    return written(reps, "representatives"), member


def links(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(pairs between representatives with their similarity, membership)."""
    reps, member = classes(df, key, text)
    near = written(candidates(reps), "near-pairs")
    return written(verified(near, df, key, text), "links"), member


def pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(registro_id_a, registro_id_b), a < b: every pair of rows of LEAST_WORDS words or more whose similarity reaches SIMILARITY, copies included.

    Rows of null, empty or shorter texts are in no pair. Keys are taken as unique. An empty table gives no pair.
    """
    found, member = links(df, key, text)
    m1, m2 = member.withColumnsRenamed({"id": "x", "rep": "a"}), member.withColumnsRenamed({"id": "y", "rep": "b"})
    across = found.select("a", "b").join(m1, "a").join(m2, "b").select(F.least("x", "y").alias("registro_id_a"), F.greatest("x", "y").alias("registro_id_b"))
    copied = member.groupBy("rep").agg(F.count("*").alias("k")).where("k > 1").select("rep")
    own = member.join(copied, "rep")
    within = own.select("rep", F.col("id").alias("registro_id_a")).join(
        own.select("rep", F.col("id").alias("registro_id_b")), "rep"
    ).where("registro_id_a < registro_id_b").select("registro_id_a", "registro_id_b")
    return across.unionByName(within)


def groups(df: DataFrame, key: str, text: str) -> DataFrame:
    """(registro_id, classe, grupo, ligacoes) of every row: its class of equal shingle sets (lowest key), its group of
    linked classes (lowest key), and how many other classes it is linked to. A row without a sketch is a class and a
    group of its own, with no link.
    """
    found, member = links(df, key, text)
    edges = written(found.select(F.col("a").alias("u"), F.col("b").alias("v")).union(found.select("b", "a")), "edges")
    label = edges.select("u").distinct().select("u", F.col("u").alias("g"))
    while True:
        # the lowest label of a node and its neighbours, then the label of that label
        step = edges.join(label.withColumnsRenamed({"u": "v", "g": "h"}), "v").groupBy("u").agg(F.min("h").alias("h"))
        new = label.join(step, "u").select("u", F.least("g", "h").alias("g"), F.col("g").alias("old"))
        jump = new.select(F.col("u").alias("g"), F.col("g").alias("to"))
        new = written(new.join(jump, "g", "left").select("u", F.coalesce("to", "g").alias("g"), "old"), "labels")
        label = new.select("u", "g")
        if new.where("g <> old").isEmpty():
            break
    degree = edges.groupBy("u").agg(F.count("*").alias("ligacoes"))
    rows = df.select(F.col(key).cast("long").alias("registro_id"))
    out = rows.join(member.withColumnRenamed("id", "registro_id"), "registro_id", "left").withColumn("classe", F.coalesce("rep", "registro_id"))
    return out.join(label, F.col("classe") == label.u, "left").select("registro_id", "classe", F.coalesce("g", "classe").alias("grupo")).join(degree, F.col("classe") == degree.u, "left").select(
        "registro_id", "classe", "grupo", F.coalesce("ligacoes", F.lit(0)).alias("ligacoes")
    )
