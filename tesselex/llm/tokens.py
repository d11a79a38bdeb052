"""Token ids of every document and token totals per slice."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tesselex.llm.bpe import encoder
from tesselex.llm.bpe import vocabulary as placed
from tesselex.plans.lineage import written

#: Rows of one Arrow batch that are held as Python strings at a time.
STEP = 512
#: Distinct (slice, piece) pairs a task counts before it hands them on.
HELD_PAIRS = 250_000


def encode_ids(df: DataFrame, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """(key, ids array<int>): one row per input row. Null and empty texts give an empty list, a blank text is encoded as it
    is; other columns are dropped, so their names cannot clash.
    """
    path = placed(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                ids = [enc.encode(t) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], [key, "ids"])

    kind = df.schema[key].dataType
    return df.select(key, F.col(text).cast("string").alias("__text")).mapInArrow(
        run, T.StructType([T.StructField(key, kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    )


def count_tokens(df: DataFrame, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """(key, n_tokens): 0 for null and empty texts."""
    path = placed(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                n = [sum(map(len, map(enc.__getitem__, enc.pieces(t)))) if t else 0 for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64())], [key, "n_tokens"])

    kind = df.schema[key].dataType
    return df.select(key, F.col(text).cast("string").alias("__text")).mapInArrow(run, T.StructType([T.StructField(key, kind), T.StructField("n_tokens", T.LongType())]))


def first_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of lowest `order` of each `key`; rows of null key are all kept. The limit runs before the shuffle too, so a
    hot key sends one row per task.
    """
    null = F.when(F.col(key).isNull(), F.col(order).cast("long"))
    own = F.struct(F.col(key).alias("k"), null.alias("o"))
    w = Window.partitionBy(own).orderBy(F.col(order))
    return df.withColumn("__first", F.row_number().over(w)).where("__first = 1").drop("__first")


def token_budget(df: DataFrame, slices: dict[str, Column], text: str, vocabulary: str | None = None) -> DataFrame:
    """One row per combination of `slices` (null is a slice of its own): registros, tokens.

    Tasks split texts into the vocabulary's pieces and send on only piece counts per slice; each distinct piece is
    tokenized once and its length joined back. Records of null or empty text count with no tokens. Exact.
    """
    path = placed(df.sparkSession, vocabulary)
    names = list(slices)
    kinds = df.select(*[c.alias(n) for n, c in slices.items()]).schema
    out = T.StructType([*kinds.fields, T.StructField("__piece", T.StringType()), T.StructField("__n", T.LongType())])
    arrow_kinds: list[pa.DataType] = []

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(path).pieces
        held: dict[tuple, Counter] = {}
        size = 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            for own, counts in held.items():
                keys = list(counts)
                cols = [pa.array([v] * len(keys), k) for v, k in zip(own, arrow_kinds)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(keys, pa.string()), pa.array([counts[k] for k in keys], pa.int64())], [*names, "__piece", "__n"])
            held.clear()

        for batch in batches:
            if not arrow_kinds:
                arrow_kinds.extend(batch.schema.field(i).type for i in range(len(names)))
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                for *own, t in zip(*[part.column(i).to_pylist() for i in range(len(names) + 1)]):
                    counts = held.setdefault(tuple(own), Counter())
                    before = len(counts)
                    counts[None] += 1
                    if t:
                        counts.update(pieces(t))
                    size += len(counts) - before
                if size > HELD_PAIRS:
                    yield from hand_on()
                    size = 0
        yield from hand_on()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            own = batch.column(0)
            yield pa.RecordBatch.from_arrays([own, pa.array([len(enc[p]) for p in own.to_pylist()], pa.int64())], ["__piece", "__length"])

    freq = written(df.select(*[c.alias(n) for n, c in slices.items()], F.col(text).cast("string").alias("__text")).mapInArrow(counted, out), "piece-frequencies")
    each = freq.where("__piece is not null").select("__piece").distinct().mapInArrow(lengths, "__piece string, __length long")
    own = freq.groupBy("__piece", *names).agg(F.sum("__n").alias("__n"))
    records = F.sum(F.when(F.col("__piece").isNull(), F.col("__n")))
    total = F.coalesce(F.sum(F.col("__n") * F.col("__length")), F.lit(0)).cast("long")
    return own.join(each, "__piece", "left").groupBy(*names).agg(records.alias("registros"), total.alias("tokens"))
