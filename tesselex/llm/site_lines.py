"""Lines repeated across the records of one source.

First pass: every task keeps a lossy counting summary per source, with an error of at most ERROR of the rows it saw.
Summaries merge by adding counts and errors, so a line whose sum of counts cannot reach the threshold even with all
errors added is ruled out for certain. Second pass: exact counts of the lines left, then removal by a broadcast set.
Sets are counted before they are broadcast; more lines than BROADCAST_LINES go to the rows of their source by a sort.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselex.plans.lineage import written

SHARE = 0.05
LEAST_ROWS = 10
#: Error of a summary as a share of its rows; must be below SHARE.
ERROR = 0.01
STEP = 512
#: Up to so many lines with so many characters in all are broadcast. Beyond, rows and lines of a source meet in parts of PART_ROWS rows.
BROADCAST_LINES = 200_000
BROADCAST_CHARS = 24_000_000
PART_ROWS = 50_000
_DIGITS = re.compile(r"\d+")


def line_key(line: str) -> str | None:
    """What two equal lines share: trimmed, white space runs as one space, lower case, each run of digits as one sign. None
    for a line without a letter.
    """
    key = _DIGITS.sub("0", " ".join(line.split()).lower())
    return key if any(map(str.isalpha, key)) else None


class Summary:
    """Lossy counting over the rows of one source; a row counts each of its lines once."""

    def __init__(self, error: float) -> None:
        self.width = max(1, int(1 / error))
        self.rows = 0
        self.floor = 0
        self.held: dict[str, list[int]] = {}

    def add(self, keys: set[str]) -> None:
        self.rows += 1
        held, floor = self.held, self.floor
        for k in keys:
            if (x := held.get(k)) is not None:
                x[0] += 1
            else:
                held[k] = [1, floor]
        if self.rows % self.width == 0:
            self.floor += 1
            self.held = {k: x for k, x in held.items() if x[0] + x[1] > self.floor}


def _keys(text: str, known: dict[str, str | None]) -> list[str | None]:
    out = []
    for line in text.split("\n"):
        if line not in known:
            if len(known) > 200_000:
                known.clear()
            known[line] = line_key(line)
        out.append(known[line])
    return out


def candidates(df: DataFrame, source: str, text: str, share: float = SHARE, least: int = LEAST_ROWS, error: float = ERROR) -> DataFrame:
    """(fonte, chave): a superset of the lines that reach max(least, share * rows of the source). At most (lines per row) /
    (share - error) of a source.
    """

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str | None, Summary] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                known: dict[str, str | None] = {}
                for own, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    keys = set(_keys(t, known))
                    keys.discard(None)
                    found.setdefault(own, Summary(error)).add(keys)
        for own, s in found.items():
            keys = list(s.held)
            # the row of null chave has the rows of this summary and the error of lines that it does not hold
            counts, errors = [s.rows, *[s.held[k][0] for k in keys]], [s.floor, *[s.held[k][1] for k in keys]]
            cols = [pa.array([own] * (len(keys) + 1), pa.string()), pa.array([None, *keys], pa.string()), pa.array(counts, pa.int64()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["fonte", "chave", "n", "erro"])

    rows = df.select(F.col(source).cast("string").alias("fonte"), F.col(text).cast("string").alias("t")).where("t is not null")
    parts = rows.mapInArrow(summarised, "fonte string, chave string, n long, erro long")
    merged = written(parts.groupBy("fonte", "chave").agg(F.sum("n").alias("n"), F.sum("erro").alias("erro")), "line-summaries")
    # a line that some summaries do not hold may have had up to the floor of each of them: all floors together bound it
    total = merged.where("chave is null").select("fonte", F.col("n").alias("linhas"), F.col("erro").alias("folga"))
    lines = merged.where("chave is not null").select("fonte", "chave", "n")
    reached = F.col("n") + F.col("folga") >= F.greatest(F.lit(least), F.col("linhas") * F.lit(share))
    return lines.join(total, lines.fonte.eqNullSafe(total.fonte)).where(reached).select(lines.fonte, "chave", "linhas")


#: One row as the bodies below see it: key, source, text.
Row = tuple[int, str | None, str | None]
Body = Callable[[Iterable[Row], Callable[[str | None], frozenset[str]]], pa.RecordBatch]
_NONE: frozenset[str] = frozenset()


def few_lines(known: DataFrame) -> dict[str | None, frozenset[str]] | None:
    """Lines by source if they are few enough to be broadcast (BROADCAST_LINES and BROADCAST_CHARS, counted first), else
    None. `known` is written already.
    """
    size = known.limit(BROADCAST_LINES + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("chave")), F.lit(0)).alias("c")).first()
    if size.n > BROADCAST_LINES or size.c > BROADCAST_CHARS:
        return None
    sets: dict[str | None, set[str]] = {}
    for own, k in known.select("fonte", "chave").toLocalIterator():
        sets.setdefault(own, set()).add(k)
    return {own: frozenset(x) for own, x in sets.items()}


def with_lines(df: DataFrame, key: str, source: str, text: str, known: DataFrame, body: Body, schema: str) -> DataFrame:
    """`body` over all rows in slices, with the lines of `known` (fonte, chave, linhas; written already) that belong to a row's source.

    Few lines are broadcast once they have been counted. Otherwise rows and lines are sorted together by source, the rows
    of a large source in parts of about PART_ROWS to each of which its lines are sent; a task then holds one source's lines
    at a time, at most (lines per row) / (share - error) of them.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(source).cast("string").alias("fonte"), F.col(text).cast("string").alias("t"))
    sets = few_lines(known)
    if sets is not None:
        shared = df.sparkSession.sparkContext.broadcast(sets)

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, STEP):
                    part = batch.slice(at, STEP)
                    yield body(zip(*[c.to_pylist() for c in part.columns]), lambda own: mine.get(own, _NONE))

        return rows.mapInArrow(near, schema)

    def sorted_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = sorted_in  # no source yet
        mine: set[str] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                run: list[Row] = []
                for own, _, kind, k, i, t in zip(*[c.to_pylist() for c in part.columns]):
                    if own != now:
                        if run:
                            yield body(run, lambda _: mine)
                            run = []
                        now, mine = own, set()
                    if kind == 0:
                        mine.add(k)
                    else:
                        run.append((i, own, t))
                if run:
                    yield body(run, lambda _: mine)

    parts = known.groupBy("fonte").agg(F.greatest(F.lit(1), F.ceil(F.max("linhas") / PART_ROWS)).cast("int").alias("partes"))
    lines = known.join(parts.withColumnRenamed("fonte", "f"), F.col("fonte").eqNullSafe(F.col("f")))
    lines = lines.select(
        "fonte", F.explode(F.sequence(F.lit(0), F.col("partes") - 1)).alias("parte"), F.lit(0).alias("kind"), "chave",
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("t")
    )
    own = rows.join(parts.withColumnRenamed("fonte", "f"), F.col("fonte").eqNullSafe(F.col("f")), "left")
    part = F.pmod(F.xxhash64("id", "t"), F.coalesce("partes", F.lit(1))).cast("int")
    own = own.select("fonte", part.alias("parte"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("chave"), "id", "t")
    return own.unionByName(lines).repartition("fonte", "parte").sortWithinPartitions("fonte", "parte", "kind").mapInArrow(sorted_in, schema)


_PLACES = ("registro_id", "linha_no", "fonte", "chave")


def _places(df: DataFrame, key: str, source: str, text: str, known: DataFrame) -> DataFrame:
    """(registro_id, linha_no, fonte, chave) of every line that is known of its source."""

    def body(rows: Iterable[Row], lines: Callable[[str | None], frozenset[str]]) -> pa.RecordBatch:
        seen: dict[str, str | None] = {}
        out: list[tuple] = []
        for i, own, t in rows:
            if mine := lines(own):
                out += [(i, no, own, k) for no, k in enumerate(_keys(t, seen)) if k in mine]
        cols = list(zip(*out)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.string(), pa.string()))], list(_PLACES))

    return with_lines(df.where(F.col(text).isNotNull()), key, source, text, known, body, "registro_id long, linha_no int, fonte string, chave string")


def confirmed(df: DataFrame, key: str, source: str, text: str, share: float = SHARE, least: int = LEAST_ROWS, error: float = ERROR) -> tuple[DataFrame, DataFrame]:
    """The places of candidate lines and, of these lines, those whose exact count of rows reaches the threshold: (fonte,
    chave, registros, linhas). Both are written.
    """
    first = written(candidates(df, source, text, share, least, error), "candidate-lines")
    places = written(_places(df, key, source, text, first), "line-places")
    exact = places.select("fonte", "chave", "registro_id").distinct().groupBy("fonte", "chave").agg(F.count("*").alias("registros"))
    f = first.withColumnRenamed("fonte", "f").withColumnRenamed("chave", "c")
    both = exact.join(f, F.col("fonte").eqNullSafe(F.col("f")) & (F.col("chave") == F.col("c")))
    kept = both.where(F.col("registros") >= F.greatest(F.lit(least), F.col("linhas") * F.lit(share)))
    return places, written(kept.select("fonte", "chave", "registros", "linhas"), "confirmed-lines")


def repeated_lines(df: DataFrame, key: str, source: str, text: str, share: float = SHARE, least: int = LEAST_ROWS) -> DataFrame:
    """(registro_id, linha_no): every line to be removed. Rows of null text count for nothing; a null source is a source of
    its own; copies of a row are rows; an empty table gives no row.
    """
    places, kept = confirmed(df, key, source, text, share, least)
    k = kept.select(F.col("fonte").alias("f"), F.col("chave").alias("c"))
    return places.join(k, F.col("fonte").eqNullSafe(F.col("f")) & (F.col("chave") == F.col("c")), "left_semi").select("registro_id", "linha_no")


def without_lines(df: DataFrame, key: str, source: str, text: str, share: float = SHARE, least: int = LEAST_ROWS) -> DataFrame:
    """(registro_id, texto, linhas_removidas) of every row, its confirmed lines left out and the rest as it was; a null text stays null."""
    _, kept = confirmed(df, key, source, text, share, least)

    def body(rows: Iterable[Row], lines: Callable[[str | None], frozenset[str]]) -> pa.RecordBatch:
        seen: dict[str, str | None] = {}
        out: list[tuple] = []
        for i, own, t in rows:
            mine = lines(own)
            if t is None or not mine:
                out.append((i, t, 0))
                continue
            all_of = t.split("\n")
            left = [line for line, k in zip(all_of, _keys(t, seen)) if k not in mine]
            out.append((i, "\n".join(left), len(all_of) - len(left)))
        cols = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.int32()))], ["registro_id", "texto", "linhas_removidas"])

    return with_lines(df, key, source, text, kept, body, "registro_id long, texto string, linhas_removidas int")
