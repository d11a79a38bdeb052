"""What children must satisfy, whatever cut them, on made-up acts of every type. The chunks themselves are compared with SQL in test_catalog."""

import random
from collections import defaultdict

import regex

from tesselex.functions.pieces import PIECE
from tesselex.operators import chunks as K

WORDS = "energia tarifa contrato usina prazo multa rede carga receita outorga leilão câmara município §x Art. 5º".split()
TYPES = ["texto_integral", "voto", "nota_tecnica", "anexo", "decisao", "outro", None]
BEGINS = ["Art. 1º ", "§ 2 ", "CAPÍTULO IV ", "Parágrafo Único ", "1.2 A ", "IV – ", "RELATÓRIO ", "voto ", "art. 12. ", "3. Análise "]
COLUMNS = "registro_id long, ato_id string, tipo_documento string, ano int, arquivo_origem string, titulo string, texto string"


def part(rng):
    line = lambda k: " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, k)))
    table = lambda: "| a | b |\n|---|---|\n" + "\n".join(f"| {line(8)} | {j} |" for j in range(rng.randint(0, 40)))
    return rng.choices((lambda: rng.choice(BEGINS) + line(60), table, str, lambda: line(700), lambda: line(50)), (30, 15, 10, 5, 40))[0]()


def acts(n, seed):
    rng = random.Random(seed)
    return [(i, f"ato{i}", TYPES[i % 7], 2020, f"d{i}.pdf", f"Título {i}" if i % 3 else None, "\n".join(part(rng) for _ in range(rng.randint(1, 14)))) for i in range(n)]


def pieces(t):
    return regex.findall(PIECE, t)


def by_document(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.registro_id].append(r)
    return out


def test_children(spark):
    rows = acts(84, 1)
    df = spark.createDataFrame(rows, COLUMNS)
    found = by_document(K.children(df).orderBy("registro_id", "numero_chunk").collect())
    for i, _, kind, *_, text in rows:
        got, all_of = found[i], pieces(text)
        assert bool(got) == bool(all_of)
        if len(got) == K.CAPS.get(kind, K.OTHER_CAP) or not got:
            continue
        cut = [pieces(r.texto) for r in got]
        table = [r.contexto_juridico == K.TABLE for r in got]
        # only a table's own row may be longer
        assert all(len(x) <= K.CHILD or t for x, t in zip(cut, table))
        assert [r.numero_chunk for r in got] == list(range(1, len(got) + 1)) and {r.total_chunks for r in got} == {len(got)}
        assert [r.chunk_anterior_id for r in got[1:]] == [r.chunk_id for r in got[:-1]] == [r for r in (x.chunk_anterior_id for x in got) if r]
        words = lambda xs: [w.strip() for x in xs for w in x]
        if kind in ("voto", "outro", None):
            # window k holds the pieces from k * (size - overlap) on; the last one ends the text
            step = K.CHILD - K.OVERLAP
            assert cut == [all_of[k * step : k * step + K.CHILD] for k in range(len(cut))] and len(cut) == 1 + max(0, -(-(len(all_of) - K.CHILD) // step))
        elif not any(table):
            # nothing is lost, repeated or moved
            assert words(cut) == words([all_of])
        for x, r in zip(cut, got):
            assert len(pieces(r.texto_pai)) <= K.PARENT and (len(x) > K.PARENT or r.numero_chunk > 1 or r.texto_pai.startswith(r.texto))


def test_children_of_tables_repeat_their_header(spark):
    rows = [(1, "a", "anexo", 2020, "a.pdf", None, "| a | b |\n|---|---|\n" + "\n".join(f"| linha {j} da tabela longa | {j} |" for j in range(200)))]
    got = [r.texto.split("\n") for r in K.children(spark.createDataFrame(rows, COLUMNS)).orderBy("numero_chunk").collect()]
    assert len(got) > 5 and all(x[:2] == ["| a | b |", "|---|---|"] for x in got)
    assert [y for x in got for y in x[2:]] == rows[0][-1].split("\n")[2:]
    # a table is cut only where the next row would not have fitted
    assert all(len(pieces("\n".join([*x, y[2]]))) > K.CHILD >= len(pieces("\n".join(x))) for x, y in zip(got, got[1:]))


def test_children_packed_sizes(spark):
    df = spark.createDataFrame(acts(42, 2), COLUMNS)
    for r in K.children_packed(df).collect():
        assert len(r.texto) >= 100 and r.tokens == len(pieces(r.texto)) and r.texto in r.texto_pai
        assert r.tokens <= 256 + (r.tipo_documento == "anexo") * 60
        assert len(pieces(r.texto_pai)) <= max(512, r.tokens)
