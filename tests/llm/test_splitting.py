import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tesselex.llm import splitting


def sound(text, limit, overlap):
    got = splitting.split(text, limit, overlap)
    assert "".join(text[c:e] for _, c, e in got) == text
    assert all(e - s <= limit and 0 <= c - s <= overlap for s, c, e in got)
    assert got[0][0] == got[0][1] == 0 and all(e == c2 for (_, _, e), (_, c2, _) in zip(got, got[1:]))
    return got


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab. \ńé!", max_size=900), st.integers(30, 120), st.integers(0, 20))
def test_pieces_are_sound(text, limit, overlap):
    got = sound(text, limit, overlap)
    assert (len(got) == 1) == (len(text) <= limit)


@pytest.mark.parametrize("text", ["x" * 100_000, " " * 5000, "\n" * 5000, "", "a" * 1200, "a" * 1201, "é" * 3000])
def test_extremes(text):
    got = sound(text, 1200, 100)
    assert len(got) == (1 if len(text) <= 1200 else len(got)) and len(got) <= 1 + 2 * len(text) // 1100


def test_cuts_at_the_strongest_boundary():
    par = "\n\n".join(["Frase um aqui. Frase dois aqui.\nOutra linha do mesmo."] * 60)
    got = sound(par, 600, 50)
    assert all(par[c - 2 : c] == "\n\n" for _, c, _ in got[1:])
    words = " ".join(["palavra"] * 500)
    assert all(words[c - 1] == " " and words[s - 1] == " " for s, c, _ in sound(words, 600, 50)[1:])


def test_balanced():
    rng = random.Random(0)
    t = " ".join("w" * rng.randint(2, 9) for _ in range(3000))
    sizes = [e - s for s, _, e in sound(t, 1200, 100)]
    assert min(sizes) > 0.8 * max(sizes)


def test_operator(spark):
    rows = [(1, "x " * 700, "y" * 2400), (2, "z" * 1200, None), (3, None, ""), (4, "w " * 601, "v " * 1201), (4, "w " * 601, None)]
    df = spark.createDataFrame(rows, "row_id long, texto string, texto_pai string").selectExpr("*", "'clash' campo", "'clash' item_id", "1 f")
    got = splitting.split_oversized(df, "row_id", {"texto": 1200, "texto_pai": 2400}, "t").toPandas()
    assert set(zip(got.item_id, got.campo)) == {(1, "texto"), (4, "texto"), (4, "texto_pai")}
    assert (got.texto.str.len() == got.fim - got.inicio).all() and (got.partes > 1).all()
    assert splitting.split_oversized(df.where("false"), "row_id", {"texto": 1200}, "t").count() == 0


def test_a_long_text_with_few_boundaries_takes_linear_time():
    """Each failure concerns what follows the last sound cut, so early pieces are not cut again."""
    rng = random.Random(1)
    text = "".join("y" * rng.randint(300, 520) + rng.choice((" ", "\n\n", ". ")) for _ in range(4000))
    calls = 0
    snap = splitting._snap

    def counting(*a):
        nonlocal calls
        calls += 1
        return snap(*a)

    splitting._snap = counting
    try:
        got = sound(text, 1200, 100)
    finally:
        splitting._snap = snap
    assert calls <= 3 * len(got)
