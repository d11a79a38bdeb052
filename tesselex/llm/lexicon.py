"""In how many distinct texts of a table each word stands, counted over all rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselex.plans.lineage import written

WORD = re.compile(r"[^\W_]+")
#: A word is kept if it stands in this share of the distinct texts, and in LEAST of them; so few can reach the share that the result is bounded.
SHARE = 0.002
LEAST = 3
#: Words that a task counts before it hands them on.
HELD = 200_000


def text_words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def least_of(texts: int) -> float:
    return max(LEAST, SHARE * texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    have: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        part = pa.RecordBatch.from_arrays([pa.array(list(have), pa.string()), pa.array(list(have.values()), pa.int64())], ["w", "n"])
        have.clear()
        return part

    for batch in batches:
        for t in batch.column(0).to_pylist():
            have[""] += 1
            have.update(text_words(t))
        if len(have) > HELD:
            yield out()
    yield out()


def frequent(df: DataFrame, fields: list[str]) -> tuple[dict[str, int], int]:
    """(word in lower case -> distinct texts that hold it, number of distinct texts). Copies are brought together by a hash
    before anything is counted, partly already within a task.
    """
    texts = df.select(F.explode(F.array(*[F.col(f).cast("string") for f in fields])).alias("t")).where("t is not null")
    once = texts.groupBy(F.xxhash64("t").alias("h")).agg(F.first("t").alias("t")).select("t")
    counts = written(once.mapInArrow(_count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")), "lexicon")
    total = sum(r.n for r in counts.where("w = ''").collect())
    return {r.w: r.n for r in counts.where((F.col("w") != "") & (F.col("n") >= least_of(total))).toLocalIterator()}, total
