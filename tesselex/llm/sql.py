"""The same results as the pN_ queries in SQL, where DuckDB can say it."""

from __future__ import annotations

from tesselex.llm.bpe import VOCABULARY

#: White space as the vocabulary's pattern has it.
_WS = r"\t\n\x{0b}\f\r \x{85}\p{Z}"
_PATTERN = rf" ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}\x{{e000}}]+|[{_WS}]+"


def _tokens(texts: str) -> str:
    """textos (the rows asked for, with t), posto (bytes, rank), pecas (t, i, p), inteiras (piece, its tokens' bytes) and por_texto (t, tokens).

    Byte-pair merges are a recursive query, the lowest rank first. U+E000 is put where a run of white space leaves its
    last sign to the next piece.
    """
    return rf"""
posto as (select hex(from_base64(split_part(l, ' ', 1))) as h, cast(split_part(l, ' ', 2) as bigint) as r
    from (select unnest(string_split(content, chr(10))) as l from read_text('{VOCABULARY}')) where l <> ''),
textos as ({texts}),
marcados as (select t, regexp_replace(t, '([{_WS}]+)([{_WS}])([^{_WS}])', '\1' || chr(57344) || '\2\3', 'g') as m from (select distinct t from textos where t <> '')),
cortes as (select t, regexp_extract_all(m, $p$'s|'t|'re|'ve|'m|'ll|'d|{_PATTERN}$p$) as ps from marcados),
pecas as (select t, generate_subscripts(ps, 1) as i, unnest(ps) as p from cortes),
cada as (select p, hex(encode(p)) as h from (select distinct p from pecas)),
passo(p, partes, n) as (
    select p, list_transform(range(0, length(h) // 2), lambda i: h[2 * i + 1:2 * i + 2]), 0 from cada where h not in (select h from posto)
    union all
    select p, list_concat(list_concat(partes[1:i - 1], [partes[i] || partes[i + 1]]), partes[i + 2:]), n + 1 from (
        select s.p, s.partes, s.n, arg_min(s.i, v.r * 1000000 + s.i) as i
        from (select p, partes, n, unnest(range(1, len(partes))) as i from passo) s join posto v on v.h = s.partes[s.i] || s.partes[s.i + 1] group by 1, 2, 3)),
inteiras as (select p, [h] as partes from cada where h in (select h from posto) union all select p, arg_max(partes, n) from passo group by 1),
por_texto as (select t, cast(sum(len(partes)) as bigint) as tokens from pecas join inteiras using (p) group by 1)"""


_TRIPLES = r"""
palavras as (select registro_id, regexp_extract_all(lower(texto), '[\p{L}\p{N}]+') as w from corpus_documentos where texto is not null),
conjuntos as (select registro_id, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as g
    from palavras where len(w) >= 20)"""


def _similar(sets: str) -> str:
    """elos (a, b): pairs of `sets` (registro_id, g) of a similarity of 0.7 or more."""
    return f"""
trios as (select registro_id, unnest(g) as g from {sets}),
total as (select registro_id, len(g) as n from {sets}),
comuns as (select a.registro_id as a, b.registro_id as b, count(*) as k from trios a join trios b on a.g = b.g and a.registro_id < b.registro_id group by 1, 2),
elos as (select a, b from comuns join total x on x.registro_id = a join total y on y.registro_id = b where k >= 0.7 * (x.n + y.n - k))"""


_REPEATED = r"""
with linhas as (
    select registro_id, tipo_documento, generate_subscripts(string_split(texto, chr(10)), 1) - 1 as linha_no, unnest(string_split(texto, chr(10))) as l
    from corpus_documentos where texto is not null),
normal as (
    select registro_id, tipo_documento, linha_no, l,
        regexp_replace(lower(trim(regexp_replace(l, '[\s\x{1c}-\x{1f}\x{85}\p{Z}]+', ' ', 'g'))), '\p{Nd}+', '0', 'g') as k
    from linhas),
total as (select tipo_documento, count(*) as n from corpus_documentos where texto is not null group by 1),
alta as (
    select tipo_documento, k from normal join total using (tipo_documento)
    where regexp_matches(k, '\p{L}') group by tipo_documento, k, n
    having count(distinct registro_id) >= greatest(10, 0.05 * n))
"""
_CHUNKS_ONCE = "select tipo_documento, ano, texto as t from chunks_hierarquicos qualify chunk_id is null or row_number() over (partition by chunk_id order by row_id) = 1"

SQL: dict[str, str] = {
    "p1_found": f"with {_TRIPLES}, {_similar('conjuntos')} select a as registro_id_a, b as registro_id_b from elos",
    "p1_groups": f"""
with recursive {_TRIPLES},
membros as (select registro_id, min(registro_id) over (partition by array_to_string(list_sort(g), '|')) as classe, g from conjuntos),
unicos as (select registro_id, g from membros where registro_id = classe), {_similar('unicos')},
ambos as (select a, b from elos union all select b, a from elos),
alcance(u, v) as (select registro_id, registro_id from unicos union select r.u, e.b from alcance r join ambos e on e.a = r.v),
grupos as (select u, min(v) as grupo from alcance group by 1),
graus as (select a as u, count(*) as ligacoes from ambos group by 1)
select registro_id, coalesce(m.classe, registro_id) as classe, coalesce(grupo, registro_id) as grupo, coalesce(ligacoes, 0) as ligacoes
from corpus_documentos left join membros m using (registro_id) left join grupos on grupos.u = m.classe left join graus on graus.u = m.classe
""",
    "p2_found": _REPEATED + "select registro_id, cast(linha_no as integer) as linha_no from normal join alta using (tipo_documento, k)",
    "p2_cleaned": _REPEATED
    + """
, marcadas as (select n.registro_id, n.linha_no, n.l, a.k is not null as fora from normal n left join alta a on n.tipo_documento = a.tipo_documento and n.k = a.k),
limpas as (select registro_id, coalesce(string_agg(l, chr(10) order by linha_no) filter (where not fora), '') as texto,
    cast(count(*) filter (where fora) as integer) as linhas_removidas from marcadas group by 1)
select registro_id, t.texto as texto, coalesce(linhas_removidas, 0) as linhas_removidas from corpus_documentos left join limpas t using (registro_id)
""",
    "p3_found": """
select 'chunks_hierarquicos' as tabela, row_id as item_id, 'texto' as campo from chunks_hierarquicos where length(texto) > 1200
union all select 'chunks_hierarquicos', row_id, 'texto_pai' from chunks_hierarquicos where length(texto_pai) > 2400
union all select 'corpus_documentos', registro_id, 'texto' from corpus_documentos where length(texto) > 6000
""",
    "p3_rejoined": """
select 'chunks_hierarquicos' as tabela, row_id as item_id, 'texto' as campo, texto, true as cabem, true as repetem from chunks_hierarquicos where length(texto) > 1200
union all select 'chunks_hierarquicos', row_id, 'texto_pai', texto_pai, true, true from chunks_hierarquicos where length(texto_pai) > 2400
union all select 'corpus_documentos', registro_id, 'texto', texto, true, true from corpus_documentos where length(texto) > 6000
""",
    "p6_chunks": f"""
with recursive {_tokens(_CHUNKS_ONCE)}
select tipo_documento, ano, count(*) as registros, cast(coalesce(sum(tokens), 0) as bigint) as tokens from textos left join por_texto using (t) group by 1, 2
""",
    "p6_documents": f"""
with recursive {_tokens("select source, lang, text as t from documents")},
fatias as (select source, lang, count(*) as registros, cast(coalesce(sum(tokens), 0) as bigint) as tokens from textos left join por_texto using (t) group by 1, 2)
select s.source as source, lang, dominio, registros, tokens from fatias s left join fontes f on f.source = s.source
""",
    "p7_checksums": f"""
with recursive {_tokens("select doc_id, text as t from documents")},
lugares as (select t, i, j, x from (select t, i, generate_subscripts(partes, 1) as j, unnest(partes) as x from pecas join inteiras using (p))),
ordem as (select t, r, row_number() over (partition by t order by i, j) as o from lugares join posto on h = x),
somas as (select t, count(*) as n, sum(r * o) as soma from ordem group by 1)
select doc_id, cast(coalesce(n, 0) as integer) as n, cast(coalesce(soma, 0) as bigint) as soma from textos left join somas using (t)
""",
    "p8_totals": f"""
with recursive {_tokens("select doc_id, text as t from documents where length(text) > 0")}
select doc_id, tokens, cast(ceil(tokens / 2048.0) as bigint) as partes, true as cabe from textos join por_texto using (t)
""",
}
