"""Cleaning of page and document text."""

from __future__ import annotations

import unicodedata
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tesselex.functions import pieces as P
from tesselex.functions.metadata import strip

#: What the first layer removes, in this order.
PRINT_PROMPTS = (r"(?md)^[\s ]*Imprimir[\s ]*$", r"(?md)^[\s ]*Voltar[\s ]*$", r"(?md)^[\s ]*Topo[\s ]*$")
PAGE_MARKS = (r"(?iu)P[áa]gina[\s ]+[0-9]+[\s ]+de[\s ]+[0-9]+", r"(?iu)P[áa]g\.?[\s ]*[0-9]+(?![\p{L}\p{N}_])", r"(?iu)pg\.[\s ]*[0-9]+(?![\p{L}\p{N}_])")
SITE_MARKS = (r"(?i)https?://www2?\.aneel\.gov\.br[^\s ]*", r"(?i)www2?\.aneel\.gov\.br[^\s ]*")
COPY_MARKS = (r"(?iu)C[ÓO]PIA[\s ]+N[ÃA]O[\s ]+CONTROLADA", r"(?iu)DOCUMENTO[\s ]+CONTROLADO")
#: A page shorter than this is not judged; below this share of letters and digits it is suspect.
LEAST_PAGE_CHARS = 50
LEAST_ALPHA = 0.55


#: What a text must hold, in small letters, for any pattern of a group to match.
_GROUPS = (
    (("imprimir", "voltar", "topo"), PRINT_PROMPTS),
    (("pág", "pag", "pg."), PAGE_MARKS),
    (("aneel",), SITE_MARKS),
    (("controlad",), COPY_MARKS),
)


def boilerplate_removed(t: Column) -> Column:
    """First layer: print prompts, page, site and copy marks. Patterns are tried only on texts that hold their signs."""

    def group(signs: tuple[str, ...], patterns: tuple[str, ...]):
        def one(x: Column) -> Column:
            low, out, has = F.lower(x), x, F.lit(False)
            for p in patterns:
                out = F.regexp_replace(out, p, "")
            return P.let(low, lambda y: F.when(reduce(or_, [F.contains(y, F.lit(w)) for w in signs], has), out).otherwise(x))

        return one

    for signs, patterns in _GROUPS:
        t = P.let(t, group(signs, patterns))
    return t


def normalised(t: Column) -> Column:
    """Second layer: words joined over a line's hyphen, spaces and blank lines made single, lines stripped."""
    t = F.regexp_replace(t, r"([\p{L}\p{N}_])-\n([\p{L}\p{N}_])", "$1$2")
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, " ", " "), " {2,}", " "), r"\n{3,}", "\n\n")
    return strip(F.array_join(F.transform(F.split(t, "\n"), strip), "\n"))


def without_patterns(t: Column, patterns: Column) -> Column:
    """Third layer: without the lines that, stripped, are in `patterns`."""
    return F.array_join(F.filter(F.split(t, "\n"), lambda x: ~F.array_contains(patterns, strip(x))), "\n")


def alpha_share(t: Column) -> Column:
    """Share of letters and digits of the stripped text, null if it is too short to judge."""
    s = strip(t)
    return F.when(F.length(s) >= LEAST_PAGE_CHARS, F.length(F.regexp_replace(s, r"[^\p{L}\p{Nd}²³¹]+", "")) / F.length(s))


def quality(chars: Column, pages: Column, suspects: Column) -> Column:
    """0 without text, else 1 less twice the share of suspect pages (0.4 at most) less 0.1 for under 100 characters a page."""
    c, p, s = (F.coalesce(x, F.lit(0)) for x in (chars, pages, suspects))
    density = F.coalesce(F.floor(F.try_divide(c * 10, p) + 0.5) / 10, F.lit(0.0))
    score = 1 - F.least(F.lit(0.4), F.coalesce(F.try_divide(s * 2.0, p), F.lit(0.0))) - F.when(density < 100, 0.1).otherwise(0.0)
    return F.when(c == 0, F.lit(0.0)).otherwise(F.floor(F.greatest(F.lit(0.0), score) * 100 + 0.5) / 100)


def quality_read(chars: Column, pages: Column, suspects: Column, scanned: Column) -> Column:
    """The variant for files that may be scanned: 0 for those as well."""
    return F.when(F.coalesce(scanned, F.lit(False)), F.lit(0.0)).otherwise(quality(chars, pages, suspects))


#: Signs of a text that was decoded wrongly: lost characters, and two bytes of UTF-8 read as two characters.
WRONG_ENCODING = "[\ufffd\u25a1\\x00]|[ÂÃ][\u0080-\u00bf]|â€"


def encoding_tag(t: Column) -> Column:
    """latin-1 for a text that shows signs of a wrong encoding, else utf-8. Only the text counts, whatever was noted about it."""
    return F.when(t.rlike(WRONG_ENCODING), "latin-1").otherwise("utf-8")


_BLOCK = "(?is)<({0})(?:[\\s/][^>]*)?>.*?</\\1[\\s]*>"
#: Accents by the name that an entity gives them, each a sign that combines with the letter before it.
_ACCENTS = {"acute": "\u0301", "grave": "\u0300", "circ": "\u0302", "tilde": "\u0303", "uml": "\u0308", "cedil": "\u0327", "ring": "\u030a"}
#: Other entities in use.
_SIGNS = {
    "nbsp": "\xa0", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "ordf": "ª", "ordm": "º", "deg": "°", "sect": "§", "para": "¶", "ndash": "–", "mdash": "—", "hellip": "…", "middot": "·", "bull": "•",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "euro": "€", "copy": "©", "reg": "®", "times": "×", "sup2": "²", "sup3": "³", "frac12": "½",
}


def entities() -> dict[str, str]:
    """Entity -> character: letters with accents by rule, and _SIGNS; the ampersand is left out, as it is decoded last."""
    out = {f"&{letter}{name};": made for letter in "aeiouyncAEIOUYNC" for name, sign in _ACCENTS.items() if len(made := unicodedata.normalize("NFC", letter + sign)) == 1}
    return out | {f"&{name};": c for name, c in _SIGNS.items()}


def _decoded(t: Column) -> Column:
    """Named and numbered entities as characters; a text is cut at "&" and each part that begins with an entity is put right."""
    known = F.create_map(*[F.lit(x) for pair in entities().items() for x in (pair[0][1:-1], pair[1])])
    number = lambda name: F.when(
        name.rlike("^#[xX][0-9A-Fa-f]{1,6}$"), F.conv(F.substring(name, 3, 6), 16, 10)
    ).when(name.rlike("^#[0-9]{1,7}$"), F.substring(name, 2, 7)).try_cast("int")
    # a character by its number, through its four bytes
    char = lambda n: F.when(n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))

    def part(x: Column, i: Column) -> Column:
        name = F.regexp_extract(x, "^(#?[A-Za-z0-9]{1,8});", 1)
        rest = lambda n: F.substring(x, F.length(n) + 2, F.length(x))
        return F.when(i == 0, x).otherwise(
            P.let(
                name,
                lambda n: F.when(n == "amp", F.concat(F.lit("&"), rest(n))).otherwise(
                    F.coalesce(F.concat(F.coalesce(F.try_element_at(known, n), char(number(n))), rest(n)), F.concat(F.lit("&"), x))
                )
            )
        )

    return F.when(F.contains(t, F.lit("&")), F.array_join(F.transform(F.split(t, "&"), part), "")).otherwise(t)


def html_raw(html: Column, dropped: tuple[str, ...], between: str) -> Column:
    """Text pieces of a page with a sign between them, without comments and the elements `dropped`."""
    t = F.regexp_replace(html, "(?s)<!--.*?-->", "")
    for tag in dropped:
        t = F.regexp_replace(t, _BLOCK.format(tag), between)
    return _decoded(F.regexp_replace(t, "<[^>]*>", between))


def html_text(html: Column) -> Column:
    """Text of a page, a line for each piece of text, cleaned by the first two layers: comments, navigation, headers,
    footers, scripts and styles dropped, entities decoded.
    """
    return normalised(boilerplate_removed(html_raw(html, ("script", "style", "nav", "header", "footer"), "\n")))


def html_text_plain(html: Column) -> Column:
    """The simpler reader: scripts and styles dropped only, pieces of text joined by spaces."""
    return normalised(boilerplate_removed(html_raw(html, ("script", "style"), " ")))
