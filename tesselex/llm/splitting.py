"""Cutting oversized texts into balanced pieces at natural boundaries.

The least number of pieces is computed, their equal ends placed as targets, and each target moved to the strongest
boundary near it (paragraph, line, sentence, word, any character). If a piece then breaks the limit, what follows the last
sound cut is balanced anew with one piece more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OVERLAP = 100
STEP = 256
#: Strongest first; the new piece begins where the match ends.
BOUNDARIES = (
    re.compile(r"\n[^\S\n]*\n\s*"),
    re.compile(r"\n"),
    re.compile(r"[.!?…;:][\"'”’)\]]*\s+"),
    re.compile(r"\s+"),
)
_JOINS = re.compile(r"[̀-ͯ᪰-᫿⃐-⃿‍︀-️\U0001f3fb-\U0001f3ff]|\n")


def _snap(text: str, target: int, low: int, high: int) -> int:
    """The cut in [low, high] at the strongest boundary, the nearest to `target` among equals (the earlier on a tie)."""
    for mark in BOUNDARIES:
        best = None
        for m in mark.finditer(text, max(0, low - 1), min(len(text), high + 1)):
            e = m.end()
            if low <= e <= high and (best is None or abs(e - target) < abs(best - target)):
                best = e
        if best is not None:
            return best
    at = target
    while at > low and (text[at - 1] == "‍" or _JOINS.match(text[at])):
        at -= 1
    return at if at > low else target


def _repeat(text: str, cut: int, overlap: int, least: int) -> int:
    """Start of what is repeated before `cut`: at most `overlap` characters and not beyond `least`, from a word's start
    where there is one.
    """
    low = max(least, cut - overlap)
    if low == 0 or low == cut or text[low - 1].isspace():
        return low
    m = BOUNDARIES[3].search(text, low, cut)
    return m.end() if m and m.end() < cut else low


def split(text: str, limit: int, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, cut, end) of each piece: text[start:end] is the piece, text[start:cut] repeats the one before, and the parts
    text[cut:end] give the whole text. One piece if the text fits.
    """
    n = len(text)
    if n <= limit:
        return [(0, 0, n)]
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    cuts, k = [0], 1 + -(-(n - limit) // (limit - overlap))
    while True:
        base, over, done = cuts[-1], overlap if len(cuts) > 1 else 0, len(cuts)
        whole = -(-(n - base + over + (k - 1) * overlap) // k)  # equal length of each piece with its repeat
        near = min((whole - overlap) // 3, limit - overlap - 1)
        for i in range(1, k):
            target = min(n - 1, base + i * (whole - overlap) + overlap - over)
            low = max(cuts[-1] + 1, target - near)
            high = min(n - 1, target + near, cuts[-1] + limit - (overlap if len(cuts) > 1 else 0))
            if low > high:
                break
            cuts.append(_snap(text, min(max(target, low), high), low, high))
        left = k - (len(cuts) - done)
        if left == 1 and n - cuts[-1] + (overlap if len(cuts) > 1 else 0) <= limit:
            break
        k = left + 1
    cuts.append(n)
    return [(_repeat(text, a, overlap, cuts[i - 1]) if i else 0, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def split_oversized(df: DataFrame, key: str, limits: dict[str, int], label: str, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """Pieces of every field longer than its limit: tabela (= label), item_id, campo, parte (from 0), partes, inicio, corte, fim, texto.

    A field at its limit, an empty and a null one give no row. Offsets count code points from 0. Fields are compared and
    cut one by one, so neither a very long text nor many pieces meet another row. texto is null if with_text is false.
    """
    fields = F.array(*[F.struct(F.lit(c).alias("campo"), F.lit(n).alias("limite"), F.col(c).cast("string").alias("texto")) for c, n in limits.items()])
    over = df.select(
        F.col(key).cast("long").alias("item_id"), F.explode(F.filter(fields, lambda x: F.length(x["texto"]) > x["limite"])).alias("f")
    ).select("item_id", "f.campo", "f.limite", "f.texto")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                rows: list[tuple] = []
                part = batch.slice(at, STEP)
                for item, field, limit, text in zip(*[c.to_pylist() for c in part.columns]):
                    pieces = split(text, limit, overlap)
                    rows += [(label, item, field, i, len(pieces), a, c, b, text[a:b] if with_text else None) for i, (a, c, b) in enumerate(pieces)]
                cols = list(zip(*rows)) or [()] * 9
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)],
                    ["tabela", "item_id", "campo", "parte", "partes", "inicio", "corte", "fim", "texto"]
                )

    return over.mapInArrow(run, "tabela string, item_id long, campo string, parte int, partes int, inicio int, corte int, fim int, texto string")
