import random

import pytest

from tesselex.llm import scan_noise as S

NOUNS = "energia tarifa contrato consumidor agência distribuidora decisão recurso prazo processo relatório conselho técnica garantia potência transmissão encargo receita município".split()


def act(rng):
    return "\n".join(" ".join(["A", *(rng.choice(NOUNS) for _ in range(rng.randint(20, 60)))]) + "." for _ in range(rng.randint(2, 6)))


@pytest.fixture(scope="module")
def mender():
    rng = random.Random(1)
    return S.Mender.learned([act(rng) for _ in range(300)])


def held_out(n=80, seed=99):
    rng = random.Random(seed)
    while n:
        lines, labels = S.lay_out(act(rng), ["secretaria", "arquivo", "caixa", "volume", "unidade"], rng)
        if labels.count(S.HEADER) != 1:  # a header must recur
            n -= 1
            yield lines, labels


def test_labels_on_held_out_pages(mender):
    right = total = 0
    for lines, labels in held_out():
        got = mender.labeller.label(S.observe(lines)[0]) if S.observe(lines)[1] else mender.labels(lines)
        right += sum(a == b for a, b in zip(got, labels))
        total += len(labels)
    assert right / total >= 0.97, right / total


@pytest.mark.parametrize("constant", [None, S.BODY, S.HEADER, S.PAGE, S.BREAK])
def test_the_model_decides(mender, monkeypatch, constant):
    """Headers and numbers are found by the likeliest labels alone: a labeller that always says the same finds hardly any without false ones."""
    if constant is not None:
        monkeypatch.setattr(S.Labeller, "label", lambda self, seen: [constant] * len(seen))
    true, got = set(), set()
    for i, (lines, labels) in enumerate(held_out()):
        true |= {(i, k) for k, c in (("cabecalho", S.HEADER), ("pagina", S.PAGE)) if c in labels}
        got |= {(i, k) for k in mender.noise("\n".join(lines)) if k in ("cabecalho", "pagina")}
    both, share = len(true & got), lambda n: n / len(true)
    if constant is None:
        assert share(both) >= 0.95 and both >= 0.95 * len(got)
    else:
        assert share(both) < 0.75
    if constant in (S.BODY, S.BREAK):
        assert not got


def test_lengths_are_no_limit(mender):
    body = [f"linha {w} da tarifa de energia do contrato e da garantia" for w in "abcdefghijkl"]
    head = "Secretaria de Arquivo – " + " ".join(f"volume{chr(97 + i)}" for i in range(26)) + " – caixa 12"
    assert len(head) > 200
    text = "\n".join(x for i, b in enumerate(body) for x in ([b, head, f"Página {i // 3 + 4} do total de {99:>12}"] if i % 3 == 2 else [b]))
    assert mender.noise(text) == ["cabecalho", "pagina"]
    long = "".join(NOUNS)
    assert len(long) > 100
    m = S.Mender.learned([f"A {long} paga {i}.\nOutra." for i in range(20)])
    assert m.meant(long.replace("energia", "encrgia", 1)) == long


def test_what_is_made_of_a_text_depends_on_it_alone():
    rng = random.Random(2)
    texts = [act(rng) for _ in range(20)]
    one, two = S.Labeller.counts(S.made_pages(texts, NOUNS)), S.Labeller.counts(S.made_pages(texts[::-1], NOUNS))
    assert (one == two).all() and one.sum() > 0
    halves = S.Labeller.counts(S.made_pages(texts[:7], NOUNS)) + S.Labeller.counts(S.made_pages(texts[7:], NOUNS))
    assert (one == halves).all()


def test_kinds(mender):
    rng = random.Random(5)
    assert mender.noise(None) == [] and mender.noise("  ") == [] and mender.noise("energia") == []
    assert mender.noise(act(rng)) == []
    assert mender.noise("A energia da distri-\nbuidora e a tarifa.") == ["hifen"]
    assert mender.noise("A energia da distri¬\nbuidora e a tarifa.") == ["hifen"]
    assert mender.noise("A encrgia tem tarifa.") == ["caractere"]
    assert mender.noise("A d1stribuidora tem tarifa.") == ["caractere"]
    assert mender.noise("O grupo A79, a linha LT-346kV, o código 8848f745c15b e 212kV.") == []
    assert mender.noise("Publique-se e dê-\nse ciência.") == []


def test_pages_and_headers(mender):
    body = [f"linha {w} da tarifa de energia do contrato e da garantia" for w in "abcdefghijkl"]
    text = "\n".join(x for i, b in enumerate(body) for x in ([b, "Secretaria de Arquivo – caixa 12", f"fl. {i // 3 + 4}"] if i % 3 == 2 else [b]))
    assert mender.noise(text) == ["cabecalho", "pagina"]
    assert "fl." not in mender.repaired(text) and "Secretaria" not in mender.repaired(text)


def test_repair(mender):
    got = mender.repaired("A energia da distri-\nbuidora de encrgia segue a tarifa do contrato e\nda garantia.\n\nOutra decisão.")
    assert got == "A energia da distribuidora de energia segue a tarifa do contrato e da garantia.\n\nOutra decisão."


def test_long_text(mender):
    assert mender.noise(" ".join(NOUNS) * 5000) is not None


def test_operator(spark):
    rng = random.Random(3)
    rows = [(i, act(rng)) for i in range(200)] + [(500, None), (501, ""), (502, "A energia da distri-\nbuidora."), (502, "A energia da distri-\nbuidora.")]
    df = spark.createDataFrame(rows, "registro_id long, texto string").selectExpr("*", "'x' ruido")
    assert [(r.registro_id, r.ruido) for r in S.scan_noise(df, "registro_id", "texto").collect()] == [(502, "hifen"), (502, "hifen")]
    assert {r.registro_id: r.texto for r in S.paragraphs(df, "registro_id", "texto").collect()}[502] == "A energia da distribuidora."
    assert S.scan_noise(df.where("false"), "registro_id", "texto").count() == 0


def test_misreading_of_many_copies_is_no_word(spark):
    rng = random.Random(4)
    copy = "A distribuidora paga a encrgia e a tarifa."
    rows = [(i, act(rng)) for i in range(200)] + [(1000 + i, copy) for i in range(100)]
    df = spark.createDataFrame(rows, "registro_id long, texto string")
    assert {(r.registro_id, r.ruido) for r in S.scan_noise(df, "registro_id", "texto").collect()} == {(1000 + i, "caractere") for i in range(100)}
    assert {r.texto for r in S.paragraphs(df, "registro_id", "texto").where("registro_id >= 1000").collect()} == {"A distribuidora paga a energia e a tarifa."}


def test_frequent_misreading_of_a_far_more_frequent_word():
    rng = random.Random(6)
    texts = [act(rng) + "\nA distribuidora." for _ in range(300)] + [f"A encrgia {n}." for n in NOUNS[:5]]
    assert "energia" in (m := S.Mender.learned(texts)).lexicon and m.meant("encrgia") == "energia"


def test_words_outside_the_line_sample_count(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, act(rng)) for i in range(200)], "registro_id long, texto string")
    assert len(S.train(df, "registro_id", "texto", rows=2).lexicon) >= len(NOUNS)
