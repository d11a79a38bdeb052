"""Search words of a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that searches leave out.
STOPWORDS = tuple(
    "a o e de do da em no na um uma os as dos das que para com por ao à se sua seu suas seus mas ou ser foi ele ela eles elas este essa isso pelo pela".split()
)


#: The shorter list.
FEW_STOPWORDS = tuple("a o e de do da em no na um uma os as dos das que para com por ao à se sua seu suas seus mas ou ser foi".split())


def search_words(t: Column, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    """Lower-case words of more than two characters without stopwords, in order, repeats kept; none of a null text."""
    parts = F.split(F.regexp_replace(F.lower(F.coalesce(t, F.lit(""))), r"[^\p{L}\p{N}_]+", " "), " ")
    return F.filter(parts, lambda w: (F.length(w) > 2) & ~w.isin(*stopwords))
