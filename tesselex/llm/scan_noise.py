"""Noise in text from scanned pages.

A hidden Markov model labels each line as body, running header, page number or break, and its likeliest labels stand as they
are. It is trained on pages that are laid out here from a bounded sample of the corpus' own texts, with invented headers and
numbers; only the model's counts leave the tasks. Headers and numbers are dropped, divided words joined across what stood
between, misread words replaced by frequent words, paragraphs rejoined. Words are counted over all rows, each distinct text
once.
"""

from __future__ import annotations

import random
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselex.llm import lexicon as L
from tesselex.plans.lineage import written

#: About so many rows, chosen by a hash, train the model of lines; the only sample taken.
TRAIN_ROWS = 4000
#: A word is itself misread if one confusion makes it a word that stands in so many times as many texts.
FAR_MORE = 20
STEP = 256
BODY, HEADER, PAGE, BREAK = range(4)

#: What a reader may take for what: (read, meant).
CONFUSIONS = (
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "é"), ("6", "á"), ("6", "ó"), ("6", "b"), ("8", "b"), ("9", "g"), ("4", "a"), ("3", "e"),
    ("c", "e"), ("ii", "u"), ("cl", "d"), ("rn", "m"), ("d", "cl"), ("m", "rn"), ("vv", "w"), ("li", "h"), ("g", "ç"), ("à", "ã"),
)
_HYPHENS = "-‐‑¬\xad"
_WORD = re.compile(r"[^\W_]+")
_DIVIDED = re.compile(rf"([^\W\d_]{{2,}})[{_HYPHENS}]$")
_STARTS = re.compile(r"[^\W\d_]+")
_NUMBERED = re.compile(
    r"[\[(<{|\-–—=*•~ ]*(?:(?:p[áaà]?[gq9](?:[ií1l]n[aà])?|p|f[l1i]s?|f[o0][l1i]has?|page|pp?g?)\s*[.:]*\s*(?:n[º°o.]?\s*)?)?[\dOolISB]{1,5}\s*(?:(?:/|-|de|of|do total de)\s*[\dOolISB]{1,5})?[\])>}|\-–—=*•~ ]*",
    re.I,
)
#: How an article, paragraph or item begins.
_ITEM = re.compile(r"\s*(?:art(?:igo)?\b|§|par[áa]grafo|cap[íi]tulo|se[çc][ãa]o|inciso|anexo\b|[ivxlc]+\s*[–\-)]|\d+(?:\.\d+)*[.)]?\s)", re.I)
_DIGITS = str.maketrans("OolISB", "001158")
_ENDS = ".;:!?…"
_DIGIT = re.compile(r"\d")
_WITH_DIGIT = re.compile(r"[^\W\d_]*\d[^\W_]*")
_APART = re.compile(r"[^\w\x01\n]+|_")
_BASES = {c: ord(base) for c in range(0xC0, 0x250) if (base := unicodedata.normalize("NFD", chr(c))[0]).isascii() and base.isalpha()}
_FOLD = str.maketrans({"0": "o", "1": "l", "i": "l", "5": "s", "8": "b", "c": "e", "9": "g", "q": "g", "6": "b"})


def skeletons(text: str) -> list[str]:
    """Of each line what a header's copies share in spite of misreadings and numbers that change; empty for a line without a word."""
    low = _WITH_DIGIT.sub(lambda m: "\x01" if sum(map(str.isdigit, m.group())) * 2 >= len(m.group()) else m.group(), text.lower())
    low = low.replace("ç", "g").translate(_BASES).replace("cl", "d").replace("rn", "m").replace("ii", "u").translate(_FOLD)
    return [x if x.strip("\x01 ") else "" for x in (" ".join(y.split()) for y in _APART.sub(" ", low).split("\n"))]


def _recurring(lines: list[str]) -> list[str]:
    """Skeletons of the lines that may have an equal one: those in which letters that skeletons keep as they are stand
    equally often. Empty for the others.
    """
    marks = ["%d %d %d %d %d %d" % tuple(x.count(c) + x.count(c.upper()) for c in "tpfvhz") if x else "" for x in lines]
    often = Counter(marks)
    at = [i for i, m in enumerate(marks) if m and often[m] > 1]
    out = [""] * len(lines)
    if len(at) > 1:
        for i, b in zip(at, skeletons("\n".join([lines[i] for i in at]))):
            out[i] = b
    return out


def is_number(line: str) -> bool:
    s = line.strip()
    return bool(s) and _NUMBERED.fullmatch(s) is not None and _DIGIT.search(s) is not None


def observe(lines: list[str]) -> tuple[list[tuple[int, ...]], bool]:
    """Layout features of each line (see Labeller.SIZES), and whether any line recurs or is a number at all.

    Lines that recur are judged by what all their copies show, so that copies look alike: how often they stand inside a
    sentence, whether any of them reads like prose, whether all bear one reference number.
    """
    bones = _recurring(lines)
    seen = Counter(bones)
    del seen[""]
    full = [i for i, x in enumerate(lines) if x and not x.isspace()]
    numbers: dict[int, int] = {}
    for i in full:
        if is_number(lines[i]):
            d = re.sub(r"\D", " ", lines[i]).split()
            numbers[i] = int(d[0][:9]) if d else -9
    if not numbers and (not seen or max(seen.values()) < 2):
        return [(1,) if x and not x.isspace() else (0,) for x in lines], False
    widths = sorted(len(lines[i]) for i in full)
    usual = widths[len(widths) * 3 // 4] if widths else 1
    after = dict(zip(full, full[1:]))
    before = dict(zip(full[1:], full))
    order = list(numbers.items())
    rising = {k for (i, a), (j, b) in zip(order, order[1:]) if 0 < b - a <= 2 for k in (i, j)}
    inside: set[int] = set()
    within: Counter[str] = Counter()
    prose: set[str] = set()
    digits: dict[str, set[str]] = {}
    for i in full:
        b, s = bones[i], lines[i].strip()
        p, q = lines[before[i]].rstrip() if i in before else ".", lines[after[i]].lstrip() if i in after else "."
        if p[-1] not in _ENDS and (q[:1].islower() or p[-1] in _HYPHENS) and not s[0].islower():
            inside.add(i)
        if b and seen[b] > 1:
            within[b] += i in inside
            if s[0].islower() or s[-1] in _ENDS:
                prose.add(b)
            digits.setdefault(b, set()).add("".join(c for c in s.translate(_DIGITS) if c.isdecimal()))
    same = {b for b, d in digits.items() if len(d) == 1 and len(next(iter(d))) >= 6}
    out: list[tuple[int, ...]] = []
    for i, line in enumerate(lines):
        s = line.strip()
        if not s:
            out.append((0,) * len(Labeller.SIZES))
            continue
        b, number = bones[i], i in numbers
        n = seen.get(b, 1) if b else 1
        shape = (1 if s.isdigit() else 2) if number else 3 if s[0] == "|" else 4 if len(s) * 2 < usual else 5 if len(s) * 10 < usual * 8 else 6
        item = bool(_ITEM.match(line))
        group = 1 if n < 2 else 6 if item else 2 if b in same else 3 if within[b] * 2 >= n else 4 if within[b] else 5
        near = any(k in numbers for k in (before.get(i), after.get(i)) if k is not None and abs(k - i) <= 2)
        first, last = 1 if s[0].islower() else 2 if s[0].isupper() else 3, 1 if s[-1] in _ENDS else 2 if s[-1] in _HYPHENS else 3
        out.append(
            (
                shape, min(n, 3), first, last, 1 + (i in inside), 1 + near, 1 + (i in rising), 1 + (not 0 < i < len(lines) - 1), group,
                1 if n < 2 else 2 + (b in prose), 1 + item
            )
        )
    return out, True


class Labeller:
    """Start, transition and emission log-probabilities; features are independent given the label."""

    #: Values of each feature, 0 being a blank line: shape, times the line recurs, first and last sign, inside a sentence,
    #: beside a number, number that counts on, edge of the text, what its copies show, whether one reads like prose, item.
    SIZES = (7, 4, 4, 4, 3, 3, 3, 3, 7, 4, 3)

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: list[np.ndarray]) -> None:
        self.start, self.move, self.emit = start, move, emit
        self.known: dict[tuple[int, ...], list[float]] = {}
        self.steps = move.T.tolist()

    @classmethod
    def counts(cls, pages: Iterable[tuple[list[tuple[int, ...]], list[int]]]) -> np.ndarray:
        """Starts, transitions and emissions of labelled pages, as one array that adds up over pages."""
        start, move, emit = np.zeros(4), np.zeros((4, 4)), [np.zeros((4, n)) for n in cls.SIZES]
        for seen, labels in pages:
            if labels:
                start[labels[0]] += 1
            for a, b in zip(labels, labels[1:]):
                move[a, b] += 1
            for x, k in zip(seen, labels):
                for e, v in zip(emit, x):
                    e[k, v] += 1
        return np.concatenate([start, move.ravel(), *[e.ravel() for e in emit]])

    @classmethod
    def counted(cls, counts: np.ndarray) -> Labeller:
        ends = np.cumsum([4, 16, *[4 * n for n in cls.SIZES]])
        start, move, *emit = np.split(counts + 0.5, ends[:-1])
        share = lambda x: np.log(x / x.sum(1, keepdims=True))
        return cls(np.log(start / start.sum()), share(move.reshape(4, 4)), [share(e.reshape(4, n)) for e, n in zip(emit, cls.SIZES)])

    def label(self, seen: list[tuple[int, ...]]) -> list[int]:
        """The likeliest labels (Viterbi); ties go to the lower label."""
        if not seen:
            return []
        best: list[float] = []
        back: list[list[int]] = []
        for x in seen:
            if (e := self.known.get(x)) is None:
                e = self.known[x] = sum(t[:, v] for t, v in zip(self.emit, x)).tolist()
            if not best:
                best = [a + b for a, b in zip(self.start.tolist(), e)]
                continue
            now, ways = [], []
            for k in range(4):
                row = self.steps[k]
                w, at = max((best[0] + row[0], 0), (best[1] + row[1], -1), (best[2] + row[2], -2), (best[3] + row[3], -3))
                now.append(w + e[k])
                ways.append(-at)
            best = now
            back.append(ways)
        k = best.index(max(best))
        out = [k]
        for ways in reversed(back):
            k = ways[k]
            out.append(k)
        return out[::-1]


def _misread(line: str, rng: random.Random) -> str:
    swaps = [(meant, read) for read, meant in CONFUSIONS if meant in line]
    if not swaps or rng.random() > 0.2:
        return line
    meant, read = rng.choice(swaps)
    return line.replace(meant, read, 1)


def lay_out(text: str, words: list[str], rng: random.Random) -> tuple[list[str], list[int]]:
    """Lines and labels of a made-up scan of `text`: wrapped, some words divided, header and number at the page ends."""
    width = rng.randint(48, 84)
    body: list[str] = []
    for par in text.split("\n"):
        if not par.strip() or par.startswith("|") or rng.random() < 0.1:
            body.append(par)
            continue
        line = ""
        for w in par.split():
            if line and len(line) + 1 + len(w) > width:
                room = width - len(line) - 2
                if 2 < room < len(w) - 2 and w[:room].isalpha() and rng.random() < 0.4:
                    body.append(f"{line} {w[:room]}-")
                    line = w[room:]
                    continue
                body.append(line)
                line = w
            else:
                line = f"{line} {w}" if line else w
        body.append(line)
        if rng.random() < 0.2:
            body.append("")
    pick = lambda n: " ".join(rng.choice(words) for _ in range(n))
    number = lambda: f"{rng.randint(10, 99999)}.{rng.randint(100000, 999999)}-{rng.randint(10, 99)}"
    head = rng.choice((lambda: pick(3).upper(), lambda: pick(2).title() + " – " + pick(2), lambda: f"{pick(1).title()}: {number()}     {pick(1).title()}: ____", lambda: f"{pick(1).title()} nº {number()}", lambda: f"{pick(2).title()} * {pick(1)} * {number()}", lambda: f"{pick(3).capitalize()} ({pick(1)})", lambda: f"{pick(2).title()} | {pick(2)} | {rng.randint(1, 90)}"))()
    form = rng.choice(
        ("{0}", "- {0} -", "— {0} —", "[{0}]", "Pág. {0}", "Página {0} de {1}", "página {0}", "{0}/{1}", "fl. {0}", "Fls.: {0}", "folha nº {0}", "p. {0}", "({0})")
    )
    has_head, has_number, head_first = rng.random() < 0.7, rng.random() < 0.7, rng.random() < 0.6
    lines, labels = [], []

    def put(x: str, k: int) -> None:
        lines.append(x)
        labels.append(BREAK if not x.strip() else BODY if k == PAGE and not is_number(x) else k)

    page = rng.randint(1, 30)
    every = rng.randint(8, 40)
    left = rng.randint(3, every)
    if rng.random() < 0.5:
        first = [(head, HEADER)] * has_head + [(form.format(page, page + 20), PAGE)] * has_number
        for x, k in first if head_first else first[::-1]:
            put(_misread(x, rng), k)
    for x in body:
        put(x, BODY)
        left -= 1
        if not left:
            left = rng.randint(max(3, every - 4), every + 4)
            if rng.random() < 0.3:
                put("", BREAK)
            two = [(head, HEADER)] * has_head + [(form.format(page, page + 20), PAGE)] * has_number
            for x, k in two if head_first else two[::-1]:
                put(_misread(x, rng), k)
                if rng.random() < 0.2:
                    put("", BREAK)
            page += 1
    if has_number and rng.random() < 0.3:
        put(form.format(page, page + 20), PAGE)
    return lines, labels


def _readings(low: str) -> Iterator[str]:
    """What a word may be if one character of it was misread; none for short words."""
    if len(low) < 4:
        return
    for read, right in CONFUSIONS:
        at = low.find(read)
        while at >= 0:
            yield low[:at] + right + low[at + len(read) :]
            at = low.find(read, at + 1)


def sound_words(have: dict[str, int], texts: int) -> frozenset[str]:
    """Frequent words without digits, but for those that one confusion makes a far more frequent word."""
    least = L.least_of(texts)
    return frozenset(w for w, n in have.items() if n >= least and not _DIGIT.search(w) and not any(have.get(x, 0) >= FAR_MORE * n for x in _readings(w)))


def header_words(lexicon: frozenset[str]) -> list[str]:
    """Words that invented headers are made of: none that would begin an item."""
    return sorted(w for w in lexicon if len(w) > 3 and not _ITEM.match(w)) or ["texto"]


def made_pages(texts: Iterable[str], words: list[str], seed: int = 7) -> Iterator[tuple[list[tuple[int, ...]], list[int]]]:
    """Features and labels of each text's lines, half of them laid out as a scan. What is made of a text depends on it
    alone. A header that stands once is none.
    """
    for t in texts:
        lines = t.split("\n")
        if len(lines) < 2 or any(map(is_number, lines)):
            continue
        rng = random.Random(zlib.crc32(t.encode("utf-8", "replace")) + seed)
        if rng.random() < 0.5:
            lines, labels = lay_out(t, words, rng)
            if labels.count(HEADER) == 1:
                labels[labels.index(HEADER)] = BODY
        else:
            labels = [BODY if x.strip() else BREAK for x in lines]
        seen, some = observe(lines)
        if some:
            yield seen, labels


class Mender:
    """The labeller and the lexicon of frequent words."""

    def __init__(self, labeller: Labeller, lexicon: frozenset[str]) -> None:
        self.labeller, self.lexicon = labeller, lexicon
        self.longest = max(map(len, lexicon), default=0)
        self.known: dict[str, str | None] = {}

    @classmethod
    def learned(cls, texts: list[str], seed: int = 7, counted: tuple[dict[str, int], int] | None = None) -> Mender:
        """The labeller of these texts; words as counted (see lexicon.frequent), else those of the texts."""
        if counted is None:
            once = set(texts)
            counted = Counter(w for t in once for w in L.text_words(t)), len(once)
        lexicon = sound_words(*counted)
        return cls(Labeller.counted(Labeller.counts(made_pages(texts, header_words(lexicon), seed))), lexicon)

    def labels(self, lines: list[str]) -> list[int]:
        """The model's labels. A text in which nothing recurs and no line is a number has neither headers nor page numbers by definition."""
        seen, some = observe(lines)
        return self.labeller.label(seen) if some else [BODY if x[0] else BREAK for x in seen]

    def meant(self, word: str) -> str | None:
        """What a misread word or number should be, None for a word that may stand."""
        if word in self.known:
            return self.known[word]
        if len(self.known) > 300_000:
            self.known.clear()
        got = self.known[word] = self._meant(word)
        return got

    def _meant(self, word: str) -> str | None:
        if len(word) < 3 and not word[:1].isdigit():
            return None
        low = word.lower()
        digits = sum("0" <= c <= "9" for c in word)
        letters = sum(map(str.isalpha, word))
        if digits and not letters or low in self.lexicon:
            return None
        shaped = (lambda x: x.upper()) if word.isupper() and not digits else (lambda x: x.capitalize()) if word[:1].isupper() and not word[1:2].isupper() else (lambda x: x.upper()) if sum(map(str.isupper, word)) > 1 else (lambda x: x)
        if len(word) <= self.longest + 1:  # a reading is longer or shorter by one at most
            for found in _readings(low):
                if found in self.lexicon:
                    return shaped(found)
        if not digits:
            return None
        m = re.fullmatch(r"(\d*)([lOoSs]\d+|\d+[lOoSs])(\d*)(kV|KV|MW|kW|MWh|kWh|m|h|º)?", word)
        if m and digits >= 2 * sum(c in "lOoSs" for c in "".join(m.groups("")[:3])):
            core = "".join(m.groups("")[:3])
            return core.translate(str.maketrans("lOoSs", "10055")) + m.group(4) if m.group(4) else core.translate(str.maketrans("lOoSs", "10055"))
        # a digit or two inside a word of letters that is no code: lower case, or capitals with one digit among at least five
        inner = word[1:] if word[0].isupper() else word
        lower = sum(map(str.islower, inner))
        if digits <= 2 and letters >= 4 and lower >= letters - 1 and not re.fullmatch(r"[^\W\d_]{1,4}\d+|\d+[^\W\d_]+|[^\W\d_]+\d{2,}", word):
            return shaped(low.translate(str.maketrans("015869", "olsbeg")))
        if digits == 1 and letters >= 5 and word.upper() == word and word[0].isalpha() and word[-1].isalpha():
            return low.translate(str.maketrans("015869", "olsbeg")).upper()
        return None

    def noise(self, text: str | None, labels: list[int] | None = None) -> list[str]:
        """The kinds found in a text, in a fixed order; none in a null, empty or blank one. `labels` are those of its
        lines, if they are known.
        """
        if not text or not text.strip():
            return []
        lines = text.split("\n")
        labels = labels or (self.labels(lines) if len(lines) > 1 else [BODY])
        out = []
        if len(lines) > 1 and any(True for _ in self.divided(lines, labels)):
            out.append("hifen")
        if any(self.meant(w) is not None for w in set(_WORD.findall(text))):
            out.append("caractere")
        if HEADER in labels:
            out.append("cabecalho")
        if PAGE in labels:
            out.append("pagina")
        return out

    def mended(self, text: str | None) -> tuple[str | None, list[str]]:
        """(text repaired where noise was found and as it was otherwise, the kinds); lines are labelled once."""
        if not text or not text.strip():
            return text, []
        lines = text.split("\n")
        labels = self.labels(lines) if len(lines) > 1 else [BODY]
        kinds = self.noise(text, labels)
        return (self.repaired(text, labels) if kinds else text), kinds

    def divided(self, lines: list[str], labels: list[int]) -> Iterator[tuple[int, int]]:
        """(line, next line) where a word is divided, the next line being the next of the body; blank lines are passed only
        about a page end.
        """
        body = [i for i, k in enumerate(labels) if k == BODY]
        for i, j in zip(body, body[1:]):
            line = lines[i].rstrip()
            m = _DIVIDED.search(line, max(0, line.rfind(" "))) if line[-1:] in _HYPHENS and line else None
            if not m or (j > i + 1 and not any(k in (HEADER, PAGE) for k in labels[i + 1 : j])):
                continue
            n = _STARTS.match(lines[j].lstrip())
            if not n:
                continue
            a, b = m.group(1), n.group()
            if not (b[0].islower() or b.isupper() and a.isupper()):
                continue
            if b.lower() in _CLITICS and (a + b).lower() not in self.lexicon:
                continue
            yield i, j

    def repaired(self, text: str, labels: list[int] | None = None) -> str:
        """Paragraphs of the body: no headers, no numbers, no divided or (where the meant word is known) misread words."""
        lines = text.split("\n")
        labels = labels or self.labels(lines)
        cut = dict(self.divided(lines, labels))
        usual = max((len(x) for x, k in zip(lines, labels) if k == BODY), default=0)
        out: list[str] = []
        body = [i for i, k in enumerate(labels) if k == BODY]
        glue = ""
        for n, i in enumerate(body):
            line = lines[i].strip()
            j = body[n + 1] if n + 1 < len(body) else None
            if glue == "" and out and n and body[n - 1] in cut:
                out[-1] += line
            elif glue == " " and out:
                out[-1] += " " + line
            else:
                out.append(line)
            glue = "\n"
            if j is None:
                break
            if i in cut:
                out[-1] = out[-1].rstrip(_HYPHENS)
                glue = ""
                continue
            page_end = any(k in (HEADER, PAGE) for k in labels[i + 1 : j])
            nxt = lines[j].strip()
            if (j == i + 1 or page_end) and line[-1:] not in _ENDS and not line.startswith("|") and not nxt.startswith("|") and (
                nxt[:1].islower() or len(line) > 0.75 * usual and usual < 120 or page_end and line[-1:] == ","
            ):
                glue = " "
            elif (j == i + 1) and line[-1:] in _ENDS and usual < 120 and len(line) > 0.9 * usual and nxt[:1].islower():
                glue = " "
            elif j > i + 1 and not page_end:
                out.append("")
        return _WORD.sub(lambda m: self.meant(m.group()) or m.group(), "\n".join(out))


#: Pronouns that Portuguese ties to a verb with a hyphen of its own.
_CLITICS = frozenset(("se", "lo", "la", "los", "las", "me", "te", "nos", "vos", "lhe", "lhes", "o", "a", "os", "as"))


def train(df: DataFrame, key: str, text: str, rows: int = TRAIN_ROWS) -> Mender:
    """Lines from about `rows` rows chosen by a hash of the key, words from all rows. Pages are laid out and counted in the
    tasks; the driver gets counts.
    """
    lexicon = sound_words(*L.frequent(df, [text]))
    words = df.sparkSession.sparkContext.broadcast(header_words(lexicon))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Labeller.counts([])
        for batch in batches:
            total += Labeller.counts(made_pages(batch.column(0).to_pylist(), words.value))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["c"])

    part = df.where(F.pmod(F.xxhash64(key), F.lit(max(1, df.count() // rows))) == 0).select(F.col(text).cast("string").alias("t")).where("t is not null")
    counts = written(part.mapInArrow(count, "c array<double>"), "line-counts")  # one row of a few hundred numbers a task
    each = counts.select(F.posexplode("c").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect()
    total = Labeller.counts([])
    for r in each:
        total[r.i] = r.n
    return Mender(Labeller.counted(total), lexicon)


def _shared(df: DataFrame, mender: Mender):
    x = mender.labeller
    return df.sparkSession.sparkContext.broadcast((x.start, x.move, x.emit, mender.lexicon))


def _own(value: tuple) -> Mender:
    return Mender(Labeller(*value[:3]), value[3])


def scan_noise(df: DataFrame, key: str, text: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(registro_id, ruido): a row per record and kind, see Mender.noise. Copies of a row are judged alike; an empty table gives no row."""
    shared = _shared(df, train(df, key, text, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mender = _own(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                out = [(i, k) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) for k in mender.noise(t)]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], ["registro_id", "ruido"])

    return df.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, "registro_id long, ruido string")


def paragraphs(df: DataFrame, key: str, text: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(registro_id, texto, ruidos): every row, repaired where noise was found and as it was otherwise; null stays null."""
    shared = _shared(df, train(df, key, text, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mender = _own(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                out = [(i, *mender.mended(t)) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                cols = list(zip(*out)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.list_(pa.string())))], ["registro_id", "texto", "ruidos"]
                )

    return df.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(run, "registro_id long, texto string, ruidos array<string>")
