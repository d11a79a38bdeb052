"""Tokens as pieces of a text that join back to it; by default each is a word, number or sign with the white space before it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = r"[ \t\n\r\f]*(?:[\p{L}\p{N}_]+|[^ \t\n\r\f\p{L}\p{N}_])"

#: The pre-splitting pattern of byte-level vocabularies, as another way of counting.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PATTERN: ContextVar[str] = ContextVar("pattern", default=PIECE)


@contextmanager
def counted_by(pattern: str) -> Iterator[None]:
    """Sizes and windows of expressions built inside are in the pieces that `pattern` finds, which must join back to a text."""
    token = _PATTERN.set(pattern)
    try:
        yield
    finally:
        _PATTERN.reset(token)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) for a body that yields an array, `value` being computed once however often the body, and functions
    inside it, name it. (A plain expression would be evaluated again for every element of an inner array.)
    """
    return F.flatten(F.transform(F.array(value), body))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), `value` being computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with a costly column that is computed once a row: the optimizer copies an expression into every filter and
    projection that uses it, but not through a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def pieces(t: Column) -> Column:
    return F.regexp_extract_all(t, F.lit(_PATTERN.get()), F.lit(0))


def count(t: Column) -> Column:
    """Pieces of a text; 0 for null."""
    return F.coalesce(F.regexp_count(t, F.lit(_PATTERN.get())), F.lit(0))


def head(t: Column, n: int) -> Column:
    """The first n pieces."""
    return F.array_join(F.slice(pieces(t), 1, n), "")


def windows(t: Column, size: int, overlap: int = 0) -> Column:
    """Windows of `size` pieces, each beginning `size - overlap` after the one before; the last reaches the end. None for a
    text without pieces.
    """
    step = max(1, size - overlap)

    def cut(p: Column) -> Column:
        last = F.when(F.size(p) <= size, 0).otherwise(F.ceil((F.size(p) - size) / step)).cast("int")
        return F.when(
            F.size(p) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(p, i * step + 1, size), ""))
        ).otherwise(F.array().cast("array<string>"))

    return bound(pieces(t), cut)
