"""SQL of whole documents cut into chunks, for DuckDB. Every line that begins a segment is marked first, then the text is
split at the marks.
"""

from __future__ import annotations

from tesselex.operators import chunks as K

PIECE = r"[ \t\n\r\f]*(?:[\p{L}\p{N}_]+|[^ \t\n\r\f\p{L}\p{N}_])"


def pieces(x: str) -> str:
    return f"regexp_extract_all({x}, '{PIECE}')"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\x{{0b}}\x{{a0}}]+|[\s\x{{0b}}\x{{a0}}]+$', '', 'g')"


def _pattern(p: str) -> str:
    """A pattern of the operators as RE2 has it: no-break spaces by number, "not before a word sign" as a sign or an end."""
    return p.replace("[\\s ]", r"[\s\x{0b}\x{a0}]").replace("(?![\\p{L}\\p{N}_])", r"(?:$|[^\p{L}\p{N}_])")


def _segments(x: str, begins: str, flags: str) -> str:
    """Stripped parts of a text, each begun by a line at which the rest matches. Marks need no more of the rest than a few lines."""
    near = "substr(array_to_string(l[i:i + 60], chr(10)), 1, 2000)"
    marked = f"list_transform(range(1, len(l) + 1), lambda i: case when regexp_matches({near}, '{flags}^(?:{_pattern(begins)})') then chr(1) || l[i] else l[i] end)"
    return f"(select list_filter(list_transform(string_split(array_to_string({marked}, chr(10)), chr(1)), lambda s: {strip('s')}), lambda s: s <> '') from (select string_split({x}, chr(10)) as l))"


def _name(x: str, pattern: str, flags: str) -> str:
    return strip(f"regexp_extract({x}, '{flags}^({_pattern(pattern)})', 1)")


def _windows(p: str, size: int, overlap: int = 0) -> str:
    step = size - overlap
    n = f"case when len({p}) = 0 then 0 when len({p}) <= {size} then 1 else 1 + cast(ceil((len({p}) - {size}) / {step}.0) as bigint) end"
    return f"list_transform(range({n}), lambda w: array_to_string({p}[w * {step} + 1:w * {step} + {size}], ''))"


_NONE = "cast([] as varchar[])"
#: Runs of table lines and of other lines: blocos (registro_id, ordem, tabela, bloco), blank text left out.
BLOCKS = rf"""
linhas as (select registro_id, generate_subscripts(string_split(texto, chr(10)), 1) - 1 as linha_no, unnest(string_split(texto, chr(10))) as linha from corpus_documentos where texto is not null),
f as (select *, regexp_matches(linha, '^[\s\x{{a0}}]*\|[^\n]*\|[\s\x{{a0}}]*$') as tabela from linhas),
g as (select *, sum(nova) over (partition by registro_id order by linha_no) as ordem
    from (select *, case when tabela is distinct from lag(tabela) over (partition by registro_id order by linha_no) then 1 else 0 end as nova from f)),
juntas as (select registro_id, ordem, any_value(tabela) as tabela, string_agg(linha, chr(10) order by linha_no) as t from g group by 1, 2),
blocos as (select * from (select registro_id, cast(ordem as bigint) as ordem, tabela, case when tabela then t else {strip("t")} end as bloco from juntas) where tabela or bloco <> '')"""

#: A table cut under its header: cortadas (registro_id, ordem, p).
TABLES = rf"""
tl as (select registro_id, ordem, bloco, string_split(bloco, chr(10)) as l from blocos where tabela),
th as (select *, coalesce(list_min(list_filter(list_transform(range(1, len(l) + 1), lambda i: case when regexp_matches(l[i], '^[\s\x{{a0}}]*\|[-:| ]+\|[\s\x{{a0}}]*$') then i end), lambda i: i is not null)), len(l)) as a from tl),
tk as (select registro_id, ordem, bloco, array_to_string(l[1:a], chr(10)) as cab, len({pieces("array_to_string(l[1:a], chr(10))")}) as base, l[a + 1:] as linhas from th),
tr as (select registro_id, ordem, bloco, cab, linhas, list_reduce(
    list_transform(linhas, lambda x: {{'out': {_NONE}, 'cur': chr(10) || x, 'n': cast(len({pieces('x')}) as bigint)}}),
    lambda c, x: case when base + c.n + x.n <= {K.CHILD} then {{'out': c.out, 'cur': c.cur || x.cur, 'n': c.n + x.n}}
        else {{'out': list_concat(c.out, case when c.n > 0 then [cab || c.cur] else {_NONE} end), 'cur': x.cur, 'n': x.n}} end,
    {{'out': {_NONE}, 'cur': '', 'n': cast(0 as bigint)}}) as r from tk),
cortadas as (select registro_id, ordem, case when len(linhas) = 0 or len({pieces('bloco')}) <= {K.CHILD} then [bloco]
    else list_concat(r.out, case when r.n > 0 then [cab || r.cur] else {_NONE} end) end as p from tr)"""


def _by_type(x: str, values: dict, other: object) -> str:
    text = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"case {x} " + " ".join(f"when '{k}' then {text(v)}" for k, v in values.items()) + f" else {text(other)} end"


def children(caps: dict[str, int], other: int, stem: str) -> str:
    """filhos (all columns of a child, gerados, limite, tipo): `stem` is the SQL of a file's stem."""
    ident = lambda letter, n: f"pre || '_{letter}' || case when {n} < 1000 then lpad(cast({n} as varchar), 3, '0') else cast({n} as varchar) end"
    return rf"""{BLOCKS}, {TABLES},
docs as (select registro_id, coalesce(tipo_documento, 'outro') as k, texto from corpus_documentos where {strip('texto')} <> ''),
trechos as (select registro_id, k, 1 as b, texto from docs where k not in ('nota_tecnica', 'anexo') union all
    select registro_id, k, ordem, bloco from docs join blocos using (registro_id) where k in ('nota_tecnica', 'anexo') and not tabela),
artigos as (select *, {_segments('texto', K.ARTICLE_BEGINS, '(?i)')} as s from trechos where k = 'texto_integral'),
titulos as (select *, {_segments('texto', K.HEADING_BEGINS, '')} as s from trechos where k = 'nota_tecnica'),
secoes as (select *, case when len(s1) > 1 then s1 else s2 end as s from (select *, {_segments('texto', K.PART_BEGINS, '(?i)')} as s1, {_segments('texto', K.ROMAN_BEGINS, '')} as s2 from trechos where k = 'decisao')),
segmentos as (select registro_id, b, generate_subscripts(s, 1) as u, unnest(s) as t, {_name('unnest(s)', K.ARTICLE_NAME, '(?i)')} as contexto from artigos where len(s) > 1 union all
    select registro_id, b, generate_subscripts(s, 1), unnest(s), {_name('unnest(s)', K.HEADING_NAME, '')} from titulos where len(s) > 1 union all
    select registro_id, b, generate_subscripts(s, 1), unnest(s), upper({_name('unnest(s)', K.PART_NAME, '(?i)')}) from secoes where len(s) > 1),
inteiros as (select registro_id, b, texto from artigos where len(s) < 2 union all select registro_id, b, texto from titulos where len(s) < 2 union all
    select registro_id, b, texto from secoes where len(s) < 2 union all select registro_id, b, texto from trechos where k = 'anexo'),
paras as (select registro_id, b, u, t, contexto, list_transform(list_filter(list_transform(string_split(t, chr(10)), lambda x: {strip('x')}), lambda x: x <> ''), lambda x: {{'p': x, 'n': len({pieces('x')})}}) as ps from segmentos),
dobra as (select registro_id, b, u, t, contexto, list_reduce(
    list_transform(ps, lambda x: {{'out': {_NONE}, 'cur': x.p, 'n': cast(x.n as bigint)}}),
    lambda a, x: case when a.n + x.n <= {K.CHILD} then {{'out': a.out, 'cur': case when a.cur = '' then x.cur else a.cur || chr(10) || x.cur end, 'n': a.n + x.n}}
        else {{'out': list_concat(list_concat(a.out, case when a.cur = '' then {_NONE} else [a.cur] end),
            case when x.n <= {K.CHILD} then [x.cur] else {_windows(pieces('x.cur'), K.CHILD)} end), 'cur': '', 'n': cast(0 as bigint)}} end,
    {{'out': {_NONE}, 'cur': '', 'n': cast(0 as bigint)}}) as r from paras),
partes as (select registro_id, b, u, contexto, case when len({pieces('t')}) <= {K.CHILD} then [t] else list_concat(r.out, case when r.cur = '' then {_NONE} else [r.cur] end) end as ts from dobra union all
    select registro_id, b, 1, '', {_windows('p', K.CHILD)} from (select registro_id, b, {pieces('texto')} as p from inteiros) union all
    select registro_id, b, 1, '', {_windows('p', K.CHILD, K.OVERLAP)} from (select registro_id, b, {pieces('texto')} as p from trechos where k not in ('texto_integral', 'nota_tecnica', 'decisao', 'anexo')) union all
    select registro_id, ordem, 1, '{K.TABLE}', p from cortadas join docs using (registro_id) where k in ('nota_tecnica', 'anexo')),
todos as (select registro_id, contexto, texto, row_number() over (partition by registro_id order by b, u, j) as n, count(*) over (partition by registro_id) as gerados
    from (select registro_id, b, u, contexto, generate_subscripts(ts, 1) as j, unnest(ts) as texto from partes)),
limitados as (select t.*, k, {_by_type('k', caps, other)} as limite from todos t join docs using (registro_id)),
vizinhos as (select *, count(*) over (partition by registro_id) as total, lag(texto) over v as antes, lead(texto) over v as depois from limitados where n <= limite window v as (partition by registro_id order by n)),
nomes as (select v.*, d.ato_id, d.tipo_documento, d.ano, ({stem}) || '_' || {_by_type('k', K.SHORT, 'ou')} as pre,
    array_to_string({pieces("array_to_string(list_filter([antes, v.texto, depois], lambda x: x is not null), chr(10))")}[1:{K.PARENT}], '') as pai from vizinhos v join corpus_documentos d using (registro_id)),
filhos as (select registro_id, ato_id, tipo_documento, ano, {ident('c', 'n')} as chunk_id, {ident('p', 'n')} as chunk_pai_id, contexto as contexto_juridico, cast(n as integer) as numero_chunk, cast(total as integer) as total_chunks,
    floor(n * 10000 / total + 0.5) / 10000 as posicao_relativa, case when n > 1 then {ident('c', '(n - 1)')} end as chunk_anterior_id, case when n < total then {ident('c', '(n + 1)')} end as chunk_proximo_id,
    texto, pai as texto_pai, case when gerados > limite and tipo_documento = 'anexo' then '{K.TRUNCATED}' end as aviso, cast(gerados as integer) as gerados, limite, k from nomes)"""


def _pack(x: str, size: int) -> str:
    """Units {{p, n}} packed greedily, joined by a blank line; those over the size in windows of their own."""
    return f"""list_reduce(list_transform({x}, lambda x: {{'out': {_NONE}, 'cur': x.p, 'n': cast(x.n as bigint)}}),
    lambda a, x: case when x.n > {size} then {{'out': list_concat(list_concat(a.out, case when a.cur = '' then {_NONE} else [a.cur] end), {_windows(pieces('x.cur'), size)}), 'cur': '', 'n': cast(0 as bigint)}}
        when a.n + x.n <= {size} then {{'out': a.out, 'cur': case when a.cur = '' then x.cur else a.cur || chr(10) || chr(10) || x.cur end, 'n': a.n + x.n}}
        else {{'out': list_concat(a.out, case when a.cur = '' then {_NONE} else [a.cur] end), 'cur': x.cur, 'n': x.n}} end,
    {{'out': {_NONE}, 'cur': '', 'n': cast(0 as bigint)}})"""


_BLANK_LINE = r"\n[\s\x{0b}\x{a0}]*\n"


def packed_units(source: str, units: str) -> str:
    """embalados (key, c): the packed chunks of rows (registro_id, us), those under the least length left out."""
    return f"""
contadas as (select registro_id, list_transform({units}, lambda x: {{'p': x, 'n': len({pieces('x')})}}) as us from {source}),
reduzidas as (select registro_id, {_pack('us', K.CHILD)} as r from contadas),
embalados as (select registro_id, list_filter(list_transform(list_concat(r.out, case when r.cur = '' then {_NONE} else [r.cur] end), lambda x: {strip('x')}), lambda x: length(x) >= {K.LEAST_CHARS}) as c from reduzidas)"""


def _split(x: str, mark: str, flags: str = "g") -> str:
    """Stripped parts begun by a match of `mark`, which is (what goes before)(what begins)."""
    return f"list_filter(list_transform(string_split(regexp_replace({x}, '{mark}', '\\1' || chr(1) || '\\2', '{flags}'), chr(1)), lambda s: {strip('s')}), lambda s: s <> '')"


def packed() -> str:
    lines = f"list_filter(list_transform(string_split_regex(texto, '{_BLANK_LINE}'), lambda p: {strip('p')}), lambda p: p <> '')"
    return f"with {packed_units('(select registro_id, texto from corpus_documentos where texto is not null)', lines)} select registro_id, cast(generate_subscripts(c, 1) - 1 as integer) as parte, unnest(c) as texto from embalados"


def _by_pieces(x: str, size: str, overlap: int) -> str:
    """Windows of a stripped text, stripped, short ones left out; the text whole if it fits."""
    p = pieces(strip(x))
    n = f"1 + cast(ceil((len({p}) - ({size})) / cast({size} - {overlap} as double)) as bigint)"
    many = f"list_filter(list_transform(range({n}), lambda w: {strip(f'''array_to_string(({p})[w * ({size} - {overlap}) + 1:w * ({size} - {overlap}) + ({size})], '')''')}), lambda c: length(c) >= {K.LEAST_CHARS})"
    return f"case when len({p}) = 0 then {_NONE} when len({p}) <= {size} then [array_to_string({p}, '')] else {many} end"


def packed_documents(context: str) -> str:
    """The packed variant's children. `context` is the SQL of legal_context of (titulo, ato_id, texto)."""
    s = r"[\s\x{0b}\x{a0}]"
    lines = f"list_filter(list_transform(string_split_regex(texto, '{_BLANK_LINE}+'), lambda p: {strip('p')}), lambda p: p <> '')"
    article = rf"(^|[^\p{{L}}\p{{N}}_])(Art\.{s}*[0-9])"
    paragraph = rf"()(§{s}*[0-9]|Parágrafo único)"
    section = rf"()(\n{s}*[0-9]+\.{s}*[A-Z])"
    caps = _by_type("k", K.PACKED_CAPS, K.OTHER_CAP)
    units = "case when k = 'texto_integral' then case when len(a) >= 2 then a when len(p) >= 2 then p else l end when k = 'nota_tecnica' then case when len(n) >= 2 then n else l end else l end"
    return rf"""
with docs as (select registro_id, coalesce(tipo_documento, 'outro') as k, texto, titulo from corpus_documentos where {strip('texto')} <> ''),
modos as (select registro_id, k, {_split('texto', article)} as a, {_split('texto', paragraph)} as p, {_split('texto', section)} as n, {lines} as l from docs where k in ('texto_integral', 'nota_tecnica', 'decisao')),
{packed_units('modos', units)},
cabecas as (select registro_id, texto, titulo, string_split(texto, chr(10)) as l, {strip("array_to_string(string_split(texto, chr(10))[1:3], chr(10))")} as h from docs where k = 'anexo'),
escolhidas as (select registro_id, l, case when len({pieces('h')}) > {K.HEADER_PIECES} then coalesce(titulo, '') else h end as h from cabecas),
corpos as (select registro_id, h, case when len({pieces('h')}) > 0 then array_to_string(l[4:], chr(10)) else array_to_string(l, chr(10)) end as corpo, greatest({K.CHILD} - len({pieces('h')}) - 5, 100) as z from escolhidas),
anexos as (select registro_id, list_transform({_by_pieces('corpo', 'z', K.ANNEX_OVERLAP)}, lambda c: case when h <> '' then h || chr(10) || chr(10) || c else c end) as c from corpos),
janelas as (select registro_id, {_by_pieces('texto', str(K.CHILD), K.OVERLAP)} as c from docs where k not in ('texto_integral', 'nota_tecnica', 'decisao', 'anexo')),
todas as (select * from embalados union all select * from anexos union all select * from janelas),
mantidas as (select registro_id, list_filter(list_transform(c[1:{caps}], lambda x: {strip('x')}), lambda x: length(x) >= {K.LEAST_CHARS}) as c from todas join docs using (registro_id)),
filhos as (select registro_id, len(c) as total_chunks, generate_subscripts(c, 1) - 1 as chunk_idx, unnest(c) as texto from mantidas),
perto as (select *, len({pieces('texto')}) as tokens, lag(texto) over v as b, lead(texto) over v as a from filhos window v as (partition by registro_id order by chunk_idx)),
meias as (select *, array_to_string(list_filter([b, texto, a], lambda x: x is not null), chr(10) || chr(10)) as inteira, cast(floor(({K.PARENT} - tokens) / 2.0) as integer) as m from perto),
pais as (select *, case when len({pieces('inteira')}) <= {K.PARENT} then inteira else array_to_string(list_filter([
    case when m > 0 then {strip(f"array_to_string({pieces('b')}[greatest(len({pieces('b')}) - m + 1, 1):len({pieces('b')})], '')")} end, texto,
    case when m > 0 then {strip(f"array_to_string({pieces('a')}[1:m], '')")} end], lambda x: x is not null and x <> ''), chr(10) || chr(10)) end as texto_pai from meias)
select p.registro_id as registro_id, ato_id, tipo_documento, ano, cast(chunk_idx as integer) as chunk_idx, cast(total_chunks as integer) as total_chunks, tokens, {context} as contexto_juridico, texto, texto_pai
from pais p join (select registro_id, ato_id, tipo_documento, ano, titulo from corpus_documentos) d on p.registro_id = d.registro_id"""
