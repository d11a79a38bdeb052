"""Byte-level BPE by a contiguous array of adjacent ranks.

A piece is held as part boundaries and, beside each boundary, the rank of the pair that starts there. The lowest rank is
found by a scan, its right boundary deleted, and only the two neighbouring ranks are looked up again. Pieces beyond
LONG_BYTES use the same merges from a heap over linked parts, so one line of dots does not cost the square of its length.
"""

from __future__ import annotations

import base64
import heapq
import os

import regex
from pyspark import SparkFiles
from pyspark.sql import SparkSession

#: The vocabulary's own splitting pattern and the public file's usual place; see `vocabulary` for another.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LONG_BYTES = 192
CACHED_PIECES = 300_000
_NONE = 1 << 60


def merge_scan(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a short piece: scan the rank array for its minimum until no pair has a rank."""
    starts = list(range(len(piece) + 1))
    get = ranks.get
    near = [get(piece[i : i + 2], _NONE) for i in range(len(piece) - 1)]
    while near:
        low = min(near)
        if low == _NONE:
            break
        at = near.index(low)
        del starts[at + 1]
        del near[at]
        if at < len(near):
            near[at] = get(piece[starts[at] : starts[at + 2]], _NONE)
        if at:
            near[at - 1] = get(piece[starts[at - 1] : starts[at + 1]], _NONE)
    return [ranks[piece[a:b]] for a, b in zip(starts, starts[1:])]


def merge_heap(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a long piece, by the same order of merges: lowest rank, leftmost first."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))
    get = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if gone[i]:
            continue
        j = after[i]
        if j >= n or end[j] != stop:
            continue
        gone[j], end[i], after[i] = 1, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := get(piece[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if (h := before[i]) >= 0 and (r := get(piece[h:stop])) is not None:
            heapq.heappush(heap, (r, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return out


class Encoder(dict):
    """Text piece -> tuple of ids. A missing piece is encoded once and kept, up to CACHED_PIECES, after which the memory
    starts afresh; ids never depend on it.
    """

    def __init__(self, path: str = VOCABULARY) -> None:
        super().__init__()
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pieces = regex.compile(PATTERN).findall

    def __missing__(self, piece: str) -> tuple[int, ...]:
        # a lone surrogate cannot be UTF-8; it becomes U+FFFD as in every UTF-8 reader
        raw = piece.encode("utf-8", "surrogatepass").decode("utf-8", "replace").encode("utf-8")
        one = self.ranks.get(raw)
        if one is not None:
            ids: tuple[int, ...] = (one,)
        else:
            ids = tuple((merge_scan if len(raw) <= LONG_BYTES else merge_heap)(raw, self.ranks))
        if len(self) >= CACHED_PIECES:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Ids without special tokens; none of a null or empty text."""
        out: list[int] = []
        if text:
            grow = out.extend
            for ids in map(self.__getitem__, self.pieces(text)):
                grow(ids)
        return out


_LOADED: dict[str, Encoder] = {}


def vocabulary(spark: SparkSession, path: str | None = None) -> str:
    """The vocabulary file's path: as given, or the setting spark.tesselex.vocabulary, or VOCABULARY. The file is sent
    along, so executors need not have it there.
    """
    path = path or spark.conf.get("spark.tesselex.vocabulary", VOCABULARY)
    if path not in (sent := vars(spark.sparkContext).setdefault("_tesselex_sent", set())):
        spark.sparkContext.addFile(path)
        sent.add(path)
    return path


def encoder(path: str = VOCABULARY) -> Encoder:
    """One encoder per process and vocabulary."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))
    return _LOADED[path]
