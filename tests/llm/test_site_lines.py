import random
from collections import Counter, defaultdict

from tesselex.llm import site_lines as S


def brute(rows, share=S.SHARE, least=S.LEAST_ROWS):
    total, seen = Counter(), defaultdict(Counter)
    for _, src, t in rows:
        if t is not None:
            total[src] += 1
            seen[src].update({k for x in t.split("\n") if (k := S.line_key(x))})
    keep = {(s, k) for s, c in seen.items() for k, n in c.items() if n >= max(least, share * total[s])}
    return {(i, no) for i, s, t in rows if t is not None for no, x in enumerate(t.split("\n")) if (s, S.line_key(x)) in keep}


def rows_of(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        src = None if i % 17 == 0 else "quente" if i % 3 else f"f{i % 4}"
        lines = [f"frase propria {rng.choice('abcdef')} {rng.random():.9f} {''.join(rng.choice('xyzuvw') for _ in range(6))}" for _ in range(rng.randint(0, 6))]
        if rng.random() < 0.3:
            lines.insert(0, f"  COMPARTILHE   este ato {rng.randint(1, 999)} ")
        if rng.random() < 0.055:
            lines.append("no limiar da regra")
        if rng.random() < 0.5:
            lines += ["12/34", "---", ""]
        t = None if i % 41 == 0 else "" if i % 43 == 0 else "\n".join(lines)
        out.append((i, src, t))
    return out


def test_key():
    assert S.line_key(" A  b C 12/345 ") == "a b c 0/0"
    assert S.line_key("12 - 34") is None and S.line_key("") is None


def test_summary_never_misses():
    rng = random.Random(3)
    s, true = S.Summary(0.01), Counter()
    for _ in range(5000):
        keys = {f"r{rng.randint(0, 10**9)}" for _ in range(5)} | ({"comum"} if rng.random() < 0.05 else set()) | ({"raro"} if rng.random() < 0.012 else set())
        s.add(keys)
        true.update(keys)
    assert s.floor <= 0.01 * s.rows
    for k in ("comum", "raro"):
        n, err = s.held.get(k, [0, s.floor])
        assert n <= true[k] <= n + err
    assert len(s.held) < 5000


def test_found_and_removed(spark):
    rows = rows_of(900)
    rows.append((5, rows[5][1], rows[5][2]))  # a repeated row
    df = spark.createDataFrame([(i, s, t, "x") for i, s, t in rows[:-1]], "registro_id long, tipo string, texto string, chave string").repartition(5)
    got = {(r.registro_id, r.linha_no) for r in S.repeated_lines(df, "registro_id", "tipo", "texto").collect()}
    assert got == brute(rows[:-1]) and got
    clean = {r.registro_id: (r.texto, r.linhas_removidas) for r in S.without_lines(df, "registro_id", "tipo", "texto").collect()}
    for i, _, t in rows[:-1]:
        if t is None:
            assert clean[i] == (None, 0)
        else:
            left = [x for no, x in enumerate(t.split("\n")) if (i, no) not in got]
            assert clean[i] == ("\n".join(left), len(t.split("\n")) - len(left))


def test_empty_and_small(spark):
    df = spark.createDataFrame([(i, "a", "igual") for i in range(9)], "registro_id long, tipo string, texto string")
    assert S.repeated_lines(df, "registro_id", "tipo", "texto").count() == 0  # nine rows are not ten
    assert S.repeated_lines(df.where("false"), "registro_id", "tipo", "texto").count() == 0
    assert S.without_lines(df.where("false"), "registro_id", "tipo", "texto").count() == 0


def test_more_lines_than_may_be_broadcast(spark, monkeypatch):
    rows = rows_of(900)
    df = spark.createDataFrame([(i, s, t) for i, s, t in rows], "registro_id long, tipo string, texto string").repartition(5)
    clean = {tuple(r) for r in S.without_lines(df, "registro_id", "tipo", "texto").collect()}
    monkeypatch.setattr(S, "BROADCAST_LINES", 0)
    monkeypatch.setattr(S, "PART_ROWS", 100)  # sources are met in parts
    assert {(r.registro_id, r.linha_no) for r in S.repeated_lines(df, "registro_id", "tipo", "texto").collect()} == brute(rows)
    assert {tuple(r) for r in S.without_lines(df, "registro_id", "tipo", "texto").collect()} == clean


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_LINES", 1000)
    n = 20_000  # ten rows a source
    df = spark.range(n).selectExpr("id registro_id", "concat('s', id div 10) tipo", "concat('rodape de ', id div 10, '\n', uuid(), ' x') texto")
    by = {r.linha_no: r["count"] for r in S.repeated_lines(df, "registro_id", "tipo", "texto").groupBy("linha_no").count().collect()}
    assert by == {0: n}
