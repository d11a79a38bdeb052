import random
from collections import Counter

import numpy as np
import pytest

from tesselex.llm import encoding as E

SOUND = ["A concessionária não comprovou a distribuição de energia no município", "O responsável técnico homologou a garantia física até 23/4/2017", "RESOLUÇÃO NORMATIVA Nº 5050, DE 14 DE MARÇO DE 2016", "§ 1º Após a vistoria, é necessária a comprovação – sem prejuízo", "Três câmaras e à razão de R$ 10 por mês", "SÃO CONDIÇÕES À HABILITAÇÃO: CERTIDÃO", "Parágrafo único. O órgão fará a avaliação econômica do crédito público", "equação própria da transmissão elétrica"]
RARE = ["custa € 1.250 ou £ 980, à razão de ½ por parte; código µX-7", "fabricante Ångström & Šelma opera a 60 Hz; ±2 °C", "O rótulo “ÂNCORA Ã-2” consta da placa; ¿qué?"]


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    texts = [" ".join(rng.sample(SOUND, 4)) + (" " + rng.choice(RARE) if rng.random() < 0.1 else "") for _ in range(400)]
    texts += [E.garble(t, E.CHAINS[i % 3]) or t for i, t in enumerate(texts[:12])]
    return E.learned([Counter(E.words_of(t)) for t in texts])


def test_chains_invert():
    for chain in E.CHAINS:
        for t in SOUND:
            g = E.garble(t, chain)
            if g is not None:
                assert E.restore(g, chain) == t


def test_sound_texts_stay(model):
    for t in SOUND + RARE + ["plain ascii", "a comissão de licitaçào publicará", ""]:
        assert E.examine(t, model) is None, t


def test_garbled_texts_are_found_and_restored(model):
    found = right = total = 0
    for chain in E.CHAINS:
        for t in SOUND:
            g = E.garble(t, chain)
            if g is None or g == t:
                continue
            total += 1
            x = E.examine(g, model)
            found += x is not None
            right += x is not None and x[1] == t
    assert found / total >= 0.97 and right / total >= 0.9, (found, right, total)


def test_partly_garbled(model):
    t = SOUND[0] + ". " + E.garble(SOUND[1], E.CHAINS[0]) + "\n" + SOUND[4]
    x = E.examine(t, model)
    assert x is not None and x[1] == SOUND[0] + ". " + SOUND[1] + "\n" + SOUND[4] and x[2]


def test_lost_characters_are_found(model):
    chain, text, whole = E.examine("distribui��o de energia", model)
    assert chain is None and text is None and not whole


def test_operator(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.sample(SOUND, 5)), rng.choice(SOUND), None if i % 5 else "") for i in range(300)]
    bad = {7: "texto", 8: "ementa"}
    rows = [(i, E.garble(a, E.CHAINS[1]) if bad.get(i) == "texto" else a, E.garble(b, E.CHAINS[0]) if bad.get(i) == "ementa" else b, c) for i, a, b, c in rows]
    rows.append((7, rows[7][1], None, None))  # a copy
    df = spark.createDataFrame(rows, "registro_id long, texto string, ementa string, titulo string").selectExpr("*", "'x' campo", "'y' cadeia")
    got = E.garbled_fields(df, "registro_id", ["texto", "ementa", "titulo"]).collect()
    assert sorted((r.registro_id, r.campo) for r in got) == [(7, "texto"), (7, "texto"), (8, "ementa")]
    assert E.garbled_fields(df.where("false"), "registro_id", ["texto"]).count() == 0
    assert E.garbled_fields(df.selectExpr("registro_id", "cast(null as string) texto"), "registro_id", ["texto"]).count() == 0


def test_letters_lost_to_question_marks(model):
    known = E.Known("ausência não órgão resolução temporário está esta voto resoluções até nós nãs".split())
    assert E.examine("a aus?ncia de car?ter tempor?rio", model, known) == (None, "a ausência de car?ter temporário", False)
    assert E.examine("RESOLU?ÃO da aus??ncia at? hoje", model, known) == (None, "RESOLUÇÃO da ausência até hoje", False)
    assert E.examine("o ?rg?o diz n?o?", model, known) == (None, "o ?rg?o diz não?", False)
    assert E.examine("n?s", model, known) == (None, None, False)  # two words fit
    t = E.garble(SOUND[0], E.CHAINS[0]) + " e a aus?ncia"
    assert E.examine(t, model, known)[1:] == (SOUND[0] + " e a ausência", False)
    for t in ("Gostou deste voto? Envie a um amigo", "está? esta? ?", "http://a.br/x?y e www.a.br/p?q=1 e /busca?ano=2", "voto?Envie", "qué? 1?2"):
        assert E.examine(t, model, known) is None, t


def test_operator_finds_lost_letters(spark):
    rows = [(i, f"texto {i} de não ausência e até", "ok") for i in range(40)] + [(90, "n?o ha", "s?rie"), (91, "at? aqui", "por que?")]
    df = spark.createDataFrame(rows, "registro_id long, texto string, titulo string")
    got = {(r.registro_id, r.campo): (r.cadeia, r.texto, r.completo) for r in E.garbled_fields(df, "registro_id", ["texto", "titulo"]).collect()}
    assert got == {(90, "texto"): (None, "não ha", False), (90, "titulo"): (None, None, False), (91, "texto"): (None, "até aqui", False)}


def test_lossy_writers_are_classes_of_the_classifier(model):
    for sign in E.LOSSY:
        for w in ("não", "distribuição", "município", "técnico"):
            for lost in E.lost_in(w, sign):
                i, back, _ = model.judge(lost)
                assert i > len(E.CHAINS) and back is None and E.LOSSY[i - len(E.CHAINS) - 1] in lost, lost
    assert model.judge("não")[0] == 0 and model.judge("plain")[0] == 0
    assert E.lost_in("ação", "?") == ["a??o", "a?ão", "aç?o"] and E.lost_in("plain", "?") == []


def test_counts_of_many_words_are_those_of_each():
    words = {"não": 2, "n?o": 3, "plain": 1, "é": 1, "ação?": 4}
    each = lambda xs: sum((n * np.bincount(E.features(w), minlength=E.BUCKETS) for w, n in xs), np.zeros(E.BUCKETS))
    got = E.Garbled(words).counts(words)
    assert (got[0] == each(words.items())).all()
    for i, chain in enumerate(E.CHAINS, 1):
        assert (got[i] == each((g, n) for w, n in words.items() if not w.isascii() and (g := E.garble(w, chain)) not in (None, w))).all()
    for i, sign in enumerate(E.LOSSY, 1 + len(E.CHAINS)):
        assert (got[i] == each((g, n) for w, n in words.items() for g in E.lost_in(w, sign))).all()
    assert not E.Garbled(words).counts({}).any() and not E.Garbled([]).counts({}).any()
