"""Text decoded with the wrong character encoding.

A multinomial classifier over hashed byte bigrams learns from a bounded sample of the corpus' own words, garbled by every
known chain of encodings, which chain a word went through. The chain is inverted; only what decodes strictly, and to bytes
that clean words have, is taken as restored. Words are judged one by one, so garbled parts of a sound text are found.
Writers that put a sign in place of a letter ("?", U+FFFD) are classes of the same classifier. They have no inverse: an exact
check of the letters about the sign follows, and letters are put back where one frequent word fits.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesselex.llm import lexicon

#: About so many rows, chosen by a hash, train the classifier with their words; the only sample taken. Everything is searched.
TRAIN_ROWS = 3000
BUCKETS = 1 << 14
#: Prior odds of a sound word against one chain, in nats, and the posterior odds a garbled word must show.
PRIOR = 5.5
MARGIN = 2.0
STEP = 256
_LOST = "�"


def _sloppy(name: str) -> tuple[dict[int, str], dict[str, int]]:
    """A single-byte encoding in which bytes without a character keep their number, as lenient readers do."""
    to = {b: bytes([b]).decode(name, "replace") for b in range(256)}
    to = {b: chr(b) if c == _LOST else c for b, c in to.items()}
    return to, {c: b for b, c in to.items()}


_SINGLE = {n: _sloppy(n) for n in ("latin-1", "cp1252", "iso8859-15", "cp850", "cp437", "mac-roman")}


def _to_bytes(text: str, name: str) -> bytes | None:
    if name == "utf-8":
        try:
            return text.encode("utf-8")
        except UnicodeEncodeError:
            return None
    back = _SINGLE[name][1]
    try:
        return bytes([back[c] for c in text])
    except KeyError:
        return None


def _to_text(raw: bytes, name: str) -> str | None:
    if name == "utf-8":
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return None
    to = _SINGLE[name][0]
    return "".join([to[b] for b in raw])


#: Chains of (written as, read as), applied in order.
CHAINS: tuple[tuple[tuple[str, str], ...], ...] = (
    (("utf-8", "latin-1"),),
    (("utf-8", "cp1252"),),
    (("utf-8", "cp1252"), ("utf-8", "cp1252")),
    (("utf-8", "latin-1"), ("utf-8", "latin-1")),
    (("utf-8", "cp1252"), ("utf-8", "cp1252"), ("utf-8", "cp1252")),
    (("utf-8", "iso8859-15"),),
    (("utf-8", "cp850"),),
    (("utf-8", "cp437"),),
    (("utf-8", "mac-roman"),),
    (("cp1252", "cp850"),),
    (("cp1252", "cp437"),),
    (("cp1252", "mac-roman"),),
    (("cp850", "cp1252"),),
    (("mac-roman", "cp1252"),),
)


#: What a lenient writer puts for a letter beyond ASCII, once, or once for each of its two bytes.
LOSSY = ("?", "??", _LOST, _LOST * 2)


def garble(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The text as the chain would have left it; None where it cannot be written that way."""
    for written, read in chain:
        raw = _to_bytes(text, written)
        found = None if raw is None else _to_text(raw, read)
        if found is None:
            return None
        text = found
    return text


def restore(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The original; None unless every step decodes strictly."""
    return garble(text, tuple((read, written) for written, read in reversed(chain)))


def chain_name(chain: tuple[tuple[str, str], ...]) -> str:
    return " ".join(f"{a}>{b}" for a, b in chain)


#: Chains through UTF-8, whose inverse fails on most sound text. Any bytes invert through the others.
_STRICT = frozenset(i for i, chain in enumerate(CHAINS, 1) if chain[0][0] == "utf-8")


def _telling(word: str, back: str) -> bool:
    """Whether a word may be taken as garbled between single-byte encodings: it becomes a word of three letters, or a
    foreign sign stands beside a letter.
    """
    plain = [c for c in word if c.isascii() and c.isalpha()]
    if len(plain) >= 2 and all(map(str.isupper, plain)) and any(map(str.islower, back)) and not back.endswith(("º", "ª")):
        return False
    return sum(map(str.isalpha, back)) >= 3 or any(c.isascii() and c.isalpha() for c in word) and any(not c.isascii() and not c.isalpha() for c in word)


def _broken(word: str) -> bool:
    return _LOST in word or any("\x80" <= c <= "\x9f" and c != "\x85" for c in word)


def words_of(text: str) -> list[str]:
    """Words that hold a character beyond ASCII or a "?". Only space, tab, line feed and carriage return divide, as others
    may be remains of garbled letters.
    """
    return [w for w in text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if not w.isascii() or "?" in w]


def _lost(word: str) -> list[str]:
    """The word with NUL for all its letters beyond ASCII, and for one of them where there are several."""
    at = [i for i, c in enumerate(word) if not c.isascii() and c.isalpha()]
    if not at:
        return []
    one = [word[:i] + "\0" + word[i + 1 :] for i in at]
    return one if len(at) == 1 else ["".join("\0" if i in at else c for i, c in enumerate(word)), *one]


def lost_in(word: str, sign: str) -> list[str]:
    """The word as a writer leaves it that puts `sign` for all its letters beyond ASCII, or for one of them."""
    return [x.replace("\0", sign) for x in _lost(word)]


#: A byte as what it is part of: 256 for any letter.
_KIND = np.array([256 if b > 127 or chr(b).isalpha() else b for b in range(256)], np.int64)
_KINDS = _KIND.tolist()
_MARK = ord("?")


def features(word: str) -> list[int]:
    """Buckets of the byte bigrams that hold a byte beyond ASCII or a "?", the word standing between spaces; those with a
    "?" also with any letter for the other byte.
    """
    raw = (" " + word + " ").encode("utf-8", "replace")
    out = [((a * 257 + b) * 40503) % 65537 % BUCKETS for a, b in zip(raw, raw[1:]) if a > 127 or b > 127 or a == _MARK or b == _MARK]
    if _MARK in raw:
        out += [((_KINDS[a] * 257 + _KINDS[b]) * 40503 + 1) % 65537 % BUCKETS for a, b in zip(raw, raw[1:]) if a == _MARK or b == _MARK]
    return out


def feature_places(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, index of the word) of all features of many words."""
    raws = [(" " + w + " ").encode("utf-8", "replace") for w in words]
    raw = np.frombuffer(b"".join(raws), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(raws)), np.fromiter(map(len, raws), np.int64, len(raws)))[:-1]
    a, b = raw[:-1], raw[1:]  # two words meet in two spaces, which is no feature
    mark = np.flatnonzero((a == _MARK) | (b == _MARK))
    own = np.flatnonzero((a > 127) | (b > 127) | (a == _MARK) | (b == _MARK))
    code = np.concatenate(((a[own] * 257 + b[own]) * 40503, (_KIND[a[mark]] * 257 + _KIND[b[mark]]) * 40503 + 1))
    return code % 65537 % BUCKETS, owner[np.concatenate((own, mark))]


class Garbled:
    """Features of words and of what every class makes of them, found once and counted under any weights of the words."""

    def __init__(self, words: Iterable[str]) -> None:
        self.at = {w: i for i, w in enumerate(words)}
        made: list[list[tuple[str, int]]] = [[] for _ in (*CHAINS, *LOSSY)]
        for w, i in self.at.items():
            if w.isascii():
                continue
            for own, chain in zip(made, CHAINS):
                if (g := garble(w, chain)) is not None and g != w:
                    own.append((g, i))
            lost = _lost(w)
            for own, sign in zip(made[len(CHAINS) :], LOSSY):
                own += [(x.replace("\0", sign), i) for x in lost]
        self.classes = []
        for pairs in ([(w, i) for w, i in self.at.items()], *made):
            buckets, owner = feature_places([w for w, _ in pairs])
            self.classes.append((buckets, np.fromiter((i for _, i in pairs), np.int64, len(pairs))[owner]))

    def counts(self, words: dict[str, int]) -> np.ndarray:
        weight = np.zeros(len(self.at))
        for w, n in words.items():
            weight[self.at[w]] = n
        return np.stack([np.bincount(buckets, weights=weight[own], minlength=BUCKETS) for buckets, own in self.classes])


_TOKEN = re.compile(r"[^ \n\t\r]*\?[^ \n\t\r]*")
_RUN = re.compile(r"[^\W\d_]*\?(?:\?|[^\W\d_])*")
_INNER = re.compile(r"([^\W\d_])\?+([^\W\d_])")
_ADDRESS = re.compile(r"://|^www\.|\?[^?=&]*=", re.I)
_GONE = re.compile(r"(?:[^\x00-\x7f]|\?)+")


class Known:
    """Frequent words, found by what is left of them when letters beyond ASCII are lost."""

    def __init__(self, words: Iterable[str] = ()) -> None:
        self.words = frozenset(words)
        self.by_rest: dict[str, list[str]] = defaultdict(list)
        for w in sorted(self.words):
            if not w.isascii():
                self.by_rest[_GONE.sub("?", w)].append(w)

    def fitting(self, run: str) -> list[str]:
        """The words that a run of letters and marks may have been; a mark is a lost letter, or one byte of it."""
        low = run.lower()
        form = re.compile("".join("[^\\x00-\\x7f]{1,%d}" % len(x) if x[0] == "?" else re.escape(x) for x in re.findall(r"\?+|[^?]+", low)))
        return [w for w in self.by_rest.get(_GONE.sub("?", low), ()) if form.fullmatch(w)]

    def lost(self, run: str) -> bool:
        """Whether letters were lost: a mark stands between letters (small ones do not go before a capital), or at an edge
        of no known word where it makes one.
        """
        if any(not (a.islower() and b.isupper()) for a, b in _INNER.findall(run)):
            return True
        stem = run.strip("?").lower()
        return bool(stem) and "?" not in stem and stem not in self.words and bool(self.fitting(run))

    def put_back(self, run: str) -> str:
        """The run with its letters where exactly one word fits; a mark that a question may have left is kept. The case of
        a first letter must be seen from others.
        """
        for end in (run, run.rstrip("?")):
            if "?" in end and len(found := self.fitting(end)) == 1:
                left = [c for c in end if c != "?"]
                if len(left) > 1 and all(map(str.isupper, left)):
                    return found[0].upper() + run[len(end) :]
                if end[0] != "?" and not any(map(str.isupper, left[1:])):
                    return end[0] + found[0][1:] + run[len(end) :]
        return run


def lost_letters(text: str, known: Known, model: Classifier) -> tuple[bool, str]:
    """Whether letters were replaced by "?", and the text with those put back that can be: in words that the classifier
    gives to a lossy writer, as far as the letters about the sign bear it out. Addresses are left alone.
    """
    if "?" not in text:
        return False, text
    found = False

    def of_run(m: re.Match[str]) -> str:
        nonlocal found
        if not known.lost(m.group()):
            return m.group()
        found = True
        return known.put_back(m.group())

    new = _TOKEN.sub(lambda m: _RUN.sub(of_run, m.group()) if model.judge(m.group())[0] > len(CHAINS) and not _ADDRESS.search(m.group()) else m.group(), text)
    return found, new


class Classifier:
    """Multinomial naive Bayes: class 0 is sound text, class i chain i - 1, and beyond the chains the lossy writers."""

    def __init__(self, counts: np.ndarray) -> None:
        totals = counts.sum(1, keepdims=True)
        self.log = np.log((counts + 0.1) / (totals + 0.1 * BUCKETS)).T.copy()
        self.log[:, 1:][:, totals[1:, 0] == 0] = -1e3
        self.seen = counts[0] >= 2
        self.known: dict[str, tuple[int, str | None, bool]] = {}

    def judge(self, word: str) -> tuple[int, str | None, bool]:
        """(class from 1, or 0 for a sound word, the word restored or None, whether a sound word has such bytes throughout)."""
        if (got := self.known.get(word)) is None:
            if len(self.known) > 200_000:
                self.known.clear()
            got = self.known[word] = self._judge(word)
        return got

    def _judge(self, word: str) -> tuple[int, str | None, bool]:
        at = features(word)
        if not at:
            return 0, None, True
        sound = bool(self.seen[at].all())
        score = self.log[at].sum(0)
        score[0] += PRIOR
        odds = score - score[0]
        for i in map(int, np.argsort(-odds[1:], kind="stable") + 1):
            if odds[i] <= MARGIN:
                break
            if i > len(CHAINS):
                if LOSSY[i - len(CHAINS) - 1] in word:
                    return i, None, sound
                continue
            back = restore(word, CHAINS[i - 1])
            if back is not None and back != word and (i in _STRICT or _telling(word, back)) and self.seen[features(back)].all():
                return i, back, sound
        return 0, None, sound


def train(df: DataFrame, key: str, fields: list[str], rows: int = TRAIN_ROWS) -> Classifier:
    """A classifier from the words of about `rows` rows, chosen by a hash of the key. Tasks reduce each text to the words
    that tell, with their counts; only these reach the driver.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [Counter(words_of(t)) for column in batch.columns for t in column.to_pylist() if t]
            own = [x for x in own if x]
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(x) for x in own], pa.list_(pa.string())), pa.array([list(x.values()) for x in own], pa.list_(pa.int64()))], ["w", "n"]
            )

    part = df.where(F.pmod(F.xxhash64(key), F.lit(max(1, df.count() // rows))) == 0).select(*[F.col(f).cast("string") for f in fields])
    return learned([Counter(dict(zip(r.w, r.n))) for r in part.mapInArrow(counted, "w array<string>, n array<long>").toLocalIterator()])


def _signs(word: str) -> list[str]:
    """The characters beyond ASCII and marks of a word, with the character after them where it is such a one too or follows a mark."""
    tells = [c == "?" or ord(c) > 127 for c in word] + [False]
    return [word[i : i + 2] if tells[i + 1] or c == "?" else c for i, c in enumerate(word) if tells[i]]


def learned(texts: list[Counter[str]]) -> Classifier:
    """The classifier of these texts' words: the first pass leaves out texts that hold rare characters or pairs, the second
    those in which the first finds garbled words.
    """
    have: Counter[str] = Counter()
    pairs = []
    known: dict[str, list[str]] = {}
    for words in texts:
        for w in words:
            if w not in known:
                known[w] = _signs(w)
        own = {x for w in words for x in known[w]}
        pairs.append(own)
        have.update(own)
    few = max(2, 0.005 * len(texts))
    made = Garbled(dict.fromkeys(w for words in texts for w in words))
    usual: Counter[str] = Counter()
    for words, own in zip(texts, pairs):
        if all(have[x] >= few for x in own):
            usual.update(words)
    if not usual:
        for words in texts:
            usual.update(words)
    first = Classifier(made.counts(usual))
    clean: Counter[str] = Counter()
    doubted: Counter[str] = Counter()
    for words in texts:
        bad = {w for w in words if _LOST in w or first.judge(w)[0]}
        if sum(words[w] for w in bad) <= 0.05 * sum(words.values()):
            doubted.update(bad)
            clean.update({w: n for w, n in words.items() if _LOST not in w})
    # a word that the first pass doubts is sound if several texts that are sound otherwise have it
    return Classifier(made.counts({w: n for w, n in clean.items() if w not in doubted or doubted[w] >= 3}))


def examine(text: str, model: Classifier, known: Known = Known()) -> tuple[str | None, str | None, bool] | None:
    """None for a sound text, else (chain or None, text restored or None, whether all of it is restored). Letters put back
    for "?" are a guess, so such a text is never whole.
    """
    got = None if text.isascii() else _inverted(text, model)
    base = text if got is None or got[1] is None else got[1]
    lost, new = lost_letters(base, known, model)
    if not lost:
        return got
    return got and got[0], new if new != text else None, False


def _inverted(text: str, model: Classifier) -> tuple[str | None, str | None, bool] | None:
    """As examine, but for lost letters."""
    words = words_of(text)
    votes: Counter[int] = Counter()
    lost = False
    for w in words:
        lost = lost or _broken(w)
        i = model.judge(w)[0]
        if 0 < i <= len(CHAINS):
            votes[i] += 1
    if not votes:
        return (None, None, False) if lost else None
    # the chain that restores most of the words which some chain restores
    garbled = list({w for w in words if 0 < model.judge(w)[0] <= len(CHAINS)})
    ranked = sorted(votes, key=lambda i: (-sum(restore(w, CHAINS[i - 1]) is not None for w in garbled), -votes[i], i))
    chain = CHAINS[ranked[0] - 1]
    whole = restore(text, chain)
    if whole is not None and all(model.judge(w)[0] for w in words if not model.judge(w)[2] and not w.isascii()):
        sound_before = sum(model.judge(w)[2] and not model.judge(w)[0] for w in words)
        if sound_before * 3 <= len(words):
            return chain_name(chain), whole, not _broken(whole)
    # otherwise word by word
    new: dict[str, str] = {}
    for w in set(words):
        i, back, sound = model.judge(w)
        if not i:
            alt = restore(w, chain)
            if sound:
                continue
            if alt is None or alt == w or not model.seen[features(alt)].all():
                continue
            back = alt
        if back is not None:
            new[w] = back
    parts: list[str] = []
    token = ""
    for c in text:
        if c in " \n\t\r":
            parts.append(new.get(token, token))
            parts.append(c)
            token = ""
        else:
            token += c
    parts.append(new.get(token, token))
    mended = "".join(parts)
    return chain_name(chain), mended, not any(_broken(w) or 0 < model.judge(w)[0] <= len(CHAINS) for w in words_of(mended))


def garbled_fields(df: DataFrame, key: str, fields: list[str], rows: int = TRAIN_ROWS, restored: bool = True) -> DataFrame:
    """(registro_id, campo, cadeia, texto, completo) of every field that holds garbled characters.

    cadeia is null where only lost characters (U+FFFD, control codes, "?" for letters) show it; texto is the field with all that could be
    restored, null if nothing could (or if not asked for); completo tells whether nothing garbled is left. Null and
    empty fields are sound. The words that lost letters are put back from are counted over all rows. An empty table gives no row.
    """
    model = train(df, key, fields, rows)
    words, _ = lexicon.frequent(df, fields)
    shared = df.sparkSession.sparkContext.broadcast((model.log, model.seen, list(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Classifier.__new__(Classifier)
        own.log, own.seen, frequent = shared.value
        own.known = {}
        known = Known(frequent)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                out: list[tuple] = []
                ids = part.column(0).to_pylist()
                for field, column in zip(fields, part.columns[1:]):
                    for i, t in zip(ids, column.to_pylist()):
                        if t and (not t.isascii() or "?" in t) and (x := examine(t, own, known)):
                            out.append((i, field, x[0], x[1] if restored else None, x[2]))
                cols = list(zip(*out)) or [(), (), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()))],
                    ["registro_id", "campo", "cadeia", "texto", "completo"]
                )

    return df.select(F.col(key).cast("long"), *[F.col(f).cast("string") for f in fields]).mapInArrow(
        run, "registro_id long, campo string, cadeia string, texto string, completo boolean"
    )
