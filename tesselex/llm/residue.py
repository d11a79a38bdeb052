"""Template residue, filler, error pages and script notices in place of content.

Lines are counted per host by the summaries of site_lines, and those that recur there are subtracted before anything is
searched. In what is left of a record, its residual, placeholders, filler, stack traces and requests to allow scripts count
wherever they stand, and a failed page's message where it opens or fills a paragraph. Sentences that report of such matters
do not count. Of the subtracted lines, those with evidence count only if they say more than the whole residual: a page that
is nothing but its host's usual error is found, an act under its host's usual cookie notice is kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from itertools import islice
from operator import eq

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselex.llm import site_lines

#: A line is boilerplate of its host from this share of its rows, and this many, on.
SHARE = 0.02
LEAST_ROWS = 10
ERROR = 0.005
#: A paragraph is a failed page's message if its first sentence is, or sentences with this share of its letters.
MESSAGE_SHARE = 1 / 3

#: What a placeholder holds for certain, and the placeholder; a text without the sign needs no search.
PLACEHOLDERS = tuple(
    (sign, re.compile(p))
    for sign, p in (
        ("{{", r"\{\{[^{}\n]{1,60}\}\}"),
        ("${", r"\$\{[^{}\n]{1,60}\}"),
        ("{", r"\{(?<![\w\\^_}{]\{)(?:[A-Z][A-Z_ ]{2,48}|[a-z]{2,}(?:[_.][a-z]+)+|(?:nome|valor|data|prazo|cnpj|cpf|orgao|titulo|name|date|value|title)\d?)\}"),
        ("<%", r"<%=?[^%\n]{1,60}%>"),
        ("<", r"<[A-ZÀ-Ý][A-ZÀ-Ý_ ]{2,48}>"),
        ("&lt;", r"&lt;[^\W\d_]+(?:_[^\W\d_]+)*&gt;"),
        ("[", r"\[(?:inserir|insira|preencher|preencha|informar|informe|colocar|completar|insert|enter|your|insertar|rellenar|complete|nome d|nombre d|name of)\b[^\]\n]{0,60}\]"),
        ("[", r"\[(?!SIC\]|IMAGEM\]|FIGURA\])[A-ZÀ-Ý][A-ZÀ-Ý_ ]{2,48}\]"),
        ("[", r"\[\s*[●•○■_…?*]+\s*\]"),
        ("(", r"\((?:preencher|inserir|completar|rellenar|insertar|fill in|to be completed|a definir)\b[^)\n]{0,60}\)"),
        ("@@", r"@@[\w .]{2,48}@@"),
        ("%", r"%(?<![\d%]%)[A-Z][A-Z_]{2,48}%"),
        ("#", r"#(?<![\w#]#)[A-Z][A-Z_]{2,48}#"),
        ("«", r"«[a-z]+(?:_[a-z]+)*»"),
        ("<<", r"<<[^<>|\n]{1,60}>>"),
        ("XX", r"XX(?<!\wXX)X*(?:[/.\-]X{2,})+(?:[,\-]X{2,})?\b"),
        (",XX", r",XX\b(?<=X,XX)"),
        ("$ X", r"\$ X{2,}"),
        ("__", r"__\s*/\s*__"),
        ("__", r"__(?<=[nN][º°o.] __)"),
        ("__", r"__(?<=\$ __)"),
        ("__", r"__\s+de\s+__"),
        ("/", r"/(?<=\b[dD][dD]/)[mM][mM]/(?:[aAyY]{4}|[aAyY]{2})\b"),
        ("FIXME", r"FIXME"),
        ("TBD", r"TBD\b"),
        ("TODO:", r"TODO:"),
    )
)

#: The words of the usual pseudo-Latin filler.
LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
FILLER = re.compile(
    r"insert (?:your )?(?:text|content) here|your text (?:goes )?here|type your text|replace this text|sample text|placeholder text|dummy text"
    r"|(?:digite|insira|escreva|coloque)(?: seu| o seu| o)? (?:texto |conteúdo |título )?aqui|(?:seu|o) texto (?:vai )?aqui|texto de preenchimento|substituir antes de publicar|parágrafo modelo|subtítulo de exemplo|conteúdo em elaboração"
    r"|escriba aquí|(?:su|inserte su) texto aquí|texto de relleno|contenido en elaboración"
    r"|\bbla(?:[ ,]+bla){2,}|\basdf\b|\bqwerty?\b.{0,12}\b(?:asdf|zxcv)|\blorem ipsum\b",
    re.I,
)
TRACE = re.compile(
    r"traceback \(most recent call last\)|^\s*at [\w$.<>]+\([\w$]+\.(?:java|kt|scala|cs):\d+\)|^\s*File \"[^\"\n]+\", line \d+|\b[a-z]\w*(?:\.\w+)+\.\w*(?:Exception|Error)\b"
    r"|^(?:[A-Z]\w+)?(?:Error|Exception): |(?:fatal error|parse error|warning|notice): .{0,120} on line \d+|uncaught exception|segmentation fault|core dumped|undefined (?:index|variable)|ORA-\d{5}|SQLSTATE\[",
    re.I | re.M,
)
_ALLOW = r"(?:enable|allow|activate|turn on|switch on|habilite|habilitar|ative|ativar|active|permita|permitir|ligue|aceite|accept|autorice|autorize|activar|mantenha|mantenga|keep)"
_SCRIPTS = r"(?:java ?script|scripts?|cookies)"
SCRIPTS = re.compile(
    rf"\b{_ALLOW}\b[^.!?\n]{{0,50}}\b{_SCRIPTS}\b|\bturn {_SCRIPTS} on\b"
    rf"|\b{_SCRIPTS}\b[^.!?\n]{{0,20}}[.!]? *(?:habilite|ative|enable|active|permita)"
    rf"|\b{_SCRIPTS}\b[^.!?\n]{{0,40}}(?:disabled|desativad|desabilitad|desactivad|deshabilitad|bloquead|blocked)"
    rf"|(?:navegador|browser)\b[^.!?\n]{{0,60}}(?:não (?:oferece|tem|possui) suporte|não é suportado|no es compatible|not supported|unsupported)[^.!?\n]{{0,60}}"
    rf"|\bthis (?:site|page|app|application) (?:requires|needs|uses) {_SCRIPTS}\b"
    rf"|\best[ea] (?:sítio|site|página|portal|aplicativo|sitio|aplicación) (?:requer|exige|precisa de|usa|utiliza|requiere|necesita) {_SCRIPTS}\b"
    r"|verificando se você é humano|verificando (?:o )?seu navegador|checking (?:your browser|if you are human)|verify(?:ing)? (?:that )?you are (?:a )?human|comprobando (?:su navegador|que es humano)",
    re.I,
)
MESSAGE = re.compile(
    r"\b(?:erro|error|http(?:/\d\.\d)?(?: status| error)?|código|code)[ :–-]*[1-5]\d\d\b|^\W*[45]\d\d\b[ :–-]+[A-Za-zÀ-ÿ]"
    r"|\b(?:página|documento|arquivo|endereço|conteúdo|recurso|archivo)\b[^.!?\n]{0,60}(?:não (?:foi )?(?:encontrad|localizad|existe|está dispon)|indispon(?:í|ible)|no (?:fue |se )?(?:encontr|existe|está dispon)|corrompido)"
    r"|\b(?:page|document|file|url|resource|address)\b[^.!?\n]{0,60}(?:not found|does not exist|not available|could not be (?:found|loaded)|no longer)"
    r"|\bnot found\b|\bbad gateway\b|gateway time-?out|service (?:temporarily )?unavailable|internal server error|erro interno do servidor|error interno del servidor|unexpected (?:condition|error)|erro inesperado|error inesperado"
    r"|\btente (?:novamente|mais tarde|outra vez)|try again|inténtelo|intente (?:de nuevo|nuevamente)|vuelva a intentar|recarregue|reload (?:the|this)|recargue|refresh (?:the|this) page"
    r"|(?:faça|efetue) (?:o )?login|inicie sesión|please (?:log|sign) in|sessão (?:expirou|expirada|encerrada)|session (?:has )?(?:expired|timed out)|sesión (?:ha )?(?:expir|caduc)"
    r"|(?:acesso negado|access denied|acceso denegado|forbidden|acesso proibido)(?:\W*$|[.!:–-])|(?:você )?não tem permissão|you (?:do not|don't) have permission|no tiene permiso"
    r"|em manutenção|under maintenance|en mantenimiento|voltaremos|we(?:'ll| will) be back|volveremos|temporariamente (?:fora|indispon(?:í|ible))|fora do ar|temporalmente fuera"
    r"|algo deu errado|something went wrong|algo salió mal|^\W*o+ps\b|lo sentimos|request (?:blocked|rejected)|requisição (?:bloqueada|rejeitada)|solicitud (?:bloqueada|rechazada)|muitas requisições|too many requests|demasiadas (?:solicitudes|peticiones)"
    r"|conexi[óo]n con la base|(?:conexão|falha ao conectar) com o banco|(?:database|connection) (?:error|refused|failed|timed out)|timeout ?error|time-?out exceeded|tempo (?:limite )?esgotado|tiempo de espera|nullpointerexception",
    re.I | re.M,
)
#: A sentence that says of somebody that he reports, or of a report, and so is none of the page's own.
REPORTED = re.compile(
    r"\b(?:segundo|de acordo com|conforme|consoante|according to|según|de acuerdo con)\s+(?:[oa]s?|el|la|los|las|the|seus?|suas?|um|uma|un|una)\b"
    r"|\b(?:inform|relat|registr|constat|aleg|apont|consider|declar|afirm|observ|verific|report|señal|indic|exig)(?:a|am|an|ou|aram|aron|ó|ará|arão|arán|ava|avam|aba|e|iu|ia)\b[^.!?\n]*\b(?:que|quando|se)\b"
    r"|\b(?:noted|stated|reported|said|observed|explained|alleged|notes|states|reports|says)\b[^.!?\n]*\b(?:that|when|whether)\b"
    r"|\bjá sanad|\bfoi corrigid|\bfue corregid|\bwas (?:corrected|fixed)\b",
    re.I,
)
#: What every match of FILLER, SCRIPTS, TRACE and MESSAGE holds, in lower case; a text without a pattern's signs needs no search for it.
_STOCK_SIGNS = (
    " here|your text|sample text|placeholder|dummy| aqui| aquí|preenchimento|antes de publicar|modelo,|exemplo|elabora|relleno|bla bla|bla, bla|asdf|qwert|lorem|texto vai|texto va"
)
_SCRIPT_SIGNS = "script|cookie|browser|navegador|human"
_TRACE_SIGNS = "rror|xception|fault|dumped|traceback|undefined|warning|notice|ora-|sqlstate"
_MESSAGE_SIGNS = (
    "erro|http|código|code|não encontrad|não foi encontrad|não localizad|não foi localizad|não existe|não está dispon|indisponí|indisponible|no encontr|no fue encontr|no se encontr|no existe|no está dispon|corrompido"
    "|not found|does not exist|not available|could not be|no longer|gateway|unavailable|unexpected|tente novamente|tente mais tarde|tente outra vez|try again|inténtelo|intente |vuelva a intentar|recarregue"
    "|reload th|recargue|refresh th|login|inicie sesión|log in|sign in|sessão expir|sessão encerrada|session |sesión |acesso negado|access denied|acceso denegado|forbidden|acesso proibido|não tem permissão"
    "|have permission|no tiene permiso|em manutenção|under maintenance|en mantenimiento|voltaremos|be back|volveremos|temporariamente fora|fora do ar|temporalmente fuera|algo deu errado|went wrong|algo salió mal"
    "|ops|lo sentimos|request |requisição |requisições|requests|solicitud |demasiadas|con la base|com o banco|database |connection |timeout|time-out|esgotado|tiempo de espera|nullpointer"
)
_STOCK, _SCRIPT, _TRACE, _MESSAGE = 1, 2, 4, 8


def _signs() -> ahocorasick.Automaton:
    found: dict[str, int] = {}
    for bit, signs in ((_STOCK, _STOCK_SIGNS), (_SCRIPT, _SCRIPT_SIGNS), (_TRACE, _TRACE_SIGNS), (_MESSAGE, _MESSAGE_SIGNS)):
        for x in signs.split("|"):
            found[x] = found.get(x, 0) | bit
    out = ahocorasick.Automaton()
    for x, bits in found.items():
        out.add_word(x, bits)
    out.make_automaton()
    return out


_AUTOMATON = _signs()
_STATUS = re.compile(r"\W*[45]\d\d\b[ :–-]+[A-Za-zÀ-ÿ]")
_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"(?<=[.!?;])\s+")
_STOP = re.compile(r"[.!?\n]")


def filler(text: str, low: str, signs: int) -> bool:
    """Stock phrases, pseudo-Latin, one word four times running, or one sentence three times running."""
    if signs & _STOCK and FILLER.search(text):
        return True
    words = low.split()
    if any(map(eq, words, islice(words, 1, None))):
        for a, b, c, d in zip(words, words[1:], words[2:], words[3:]):
            if a == b == c == d and any(map(str.isalpha, a)):
                return True
    if len(LATIN.intersection(words)) >= 8:
        run = 0
        for w in _WORD.findall(low):
            run = run + 1 if w in LATIN else 0
            if run >= 8:
                return True
    said = _END.split(text)
    return any(map(eq, said, islice(said, 1, None))) and any(a == b == c and len(_WORD.findall(a)) >= 2 for a, b, c in zip(said, said[1:], said[2:]))


def letters(text: str) -> int:
    return sum(map(len, _WORD.findall(text)))


def asked(text: str) -> bool:
    """Whether a sentence asks to allow scripts or cookies, or says that they fail, and does not report of that."""
    for m in SCRIPTS.finditer(text):
        begin = max((x.end() for x in _STOP.finditer(text, max(0, m.start() - 400), m.start())), default=max(0, m.start() - 400))
        end = _STOP.search(text, m.end())
        if not REPORTED.search(text, begin, end.start() if end else len(text)):
            return True
    return False


def message(paragraph: str) -> bool:
    """Whether a failed page's message opens a paragraph or fills MESSAGE_SHARE of it."""
    if not MESSAGE.search(paragraph):
        return False
    said = _END.split(paragraph.strip())
    hit = [bool(MESSAGE.search(x)) and not REPORTED.search(x) for x in said]
    return hit[0] or sum(letters(x) for x, h in zip(said, hit) if h) >= max(1.0, MESSAGE_SHARE * letters(paragraph))


def found(text: str) -> str | None:
    """Evidence in a residual, whatever its length: marcador, enchimento, scripts or erro."""
    if any(sign in text and p.search(text) for sign, p in PLACEHOLDERS):
        return "marcador"
    low = text.lower()
    signs = 0
    for _, bits in _AUTOMATON.iter(low):
        signs |= bits
    if filler(text, low, signs):
        return "enchimento"
    if signs & _SCRIPT and asked(text):
        return "scripts"
    if signs & _TRACE and TRACE.search(text):
        return "erro"
    lines = text.splitlines()
    if (signs & _MESSAGE or any(map(_STATUS.match, lines))) and any(map(message, lines)):
        return "erro"
    return None


def evidence(text: str | None, boilerplate: frozenset[str] | set[str] = frozenset()) -> str | None:
    """marcador, enchimento, scripts or erro; None for a text fit for use, also for a null, empty or blank one."""
    if not text or not text.strip():
        return None
    if not boilerplate:
        return found(text)
    residual, usual = [], []
    for x in text.split("\n"):
        (usual if site_lines.line_key(x) in boilerplate else residual).append(x)
    left = "\n".join(residual)
    kind = found(left) if left.strip() else None
    if kind or not usual:
        return kind
    said = [(x, k) for x in usual if (k := found(x))]
    return said[0][1] if said and sum(letters(x) for x, _ in said) > letters(left) else None


def residue(df: DataFrame, key: str, host: str, text: str) -> DataFrame:
    """(doc_id, evidencia): every row to be left out and the first kind of evidence found. Copies of a row are judged
    alike; an empty table gives no row.
    """
    _, kept = site_lines.confirmed(df, key, host, text, SHARE, LEAST_ROWS, ERROR)

    def body(rows: Iterable[site_lines.Row], lines: Callable[[str | None], frozenset[str]]) -> pa.RecordBatch:
        out = [(i, e) for i, own, t in rows if (e := evidence(t, lines(own)))]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], ["doc_id", "evidencia"])

    return site_lines.with_lines(df, key, host, text, kept, body, "doc_id long, evidencia string")


def fit_for_use(df: DataFrame, key: str, host: str, text: str) -> DataFrame:
    """The rows of `df` that show no residue, with all their columns. Rows are judged where they are; only more host lines
    than may be broadcast need a join.
    """
    _, kept = site_lines.confirmed(df, key, host, text, SHARE, LEAST_ROWS, ERROR)
    sets = site_lines.few_lines(kept)
    if sets is None:
        bad = residue(df, key, host, text).select(F.col("doc_id").alias("__bad"))
        return df.join(bad, df[key] == bad["__bad"], "left_anti")
    shared = df.sparkSession.sparkContext.broadcast(sets)
    at = df.columns.index(host), df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            own = zip(batch.column(at[0]).to_pylist(), batch.column(at[1]).to_pylist())
            yield batch.filter(pa.array([evidence(t, shared.value.get(None if h is None else str(h), frozenset())) is None for h, t in own], pa.bool_()))

    return df.mapInArrow(run, df.schema)
