"""Personal data in texts, also where it is disguised, at its places in the source.

Base rules find e-mail addresses, IPv4 addresses, card numbers and phone numbers as written. A
chain of transducers then rewrites what hides them (look-alike letters and digits, invisible
characters, spelled digits, "(at)" and "dot") and keeps, for every character it puts out, the
source characters it came from. The base rules run on the rewritten text, and what they find is
mapped back; a span is added if it meets none found as written, or extends it.

Defined results: an empty or null text has no spans; an empty table gives no rows; rows are judged
one by one, so repeated rows, null and equal ids don't matter; only the id and text columns are read,
and ``redact`` keeps all others; places are code points, ends exclusive. Every rule is linear in the
text, however long it or a run of digits in it is (a part of an IP address may have any number of
leading zeros).
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talentmatch.llm.words import slices
from talentmatch.session import ship_package

KINDS = ("email", "ip", "card", "phone")

# ---------------------------------------------------------------------------
# Base rules
# ---------------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# digits never match twice (possessive), so a long run of digits costs one pass
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) of what is written plainly: leftmost and non-overlapping by kind."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text)
                if all(len(v) <= 3 and int(v or "0") <= 255 for v in (p.lstrip("0") for p in m.group().split(".")))]
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start():
            digits = _NO_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15]
    return sorted(out, key=lambda x: (x[1], x[0]))


# ---------------------------------------------------------------------------
# Transducers
# ---------------------------------------------------------------------------

# Letters and signs that look like the ASCII ones they stand for.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ё": "e", "к": "k", "т": "t", "в": "b", "н": "h", "м": "m",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "τ": "t", "ε": "e",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "Υ": "Y",
    "ı": "i", "ɡ": "g", "ɑ": "a", "ⅼ": "l", "ℓ": "l",
    "․": ".", "。": ".", "．": ".", "‧": ".", "﹒": ".", "﹫": "@", "＠": "@",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹣": "-", "﹢": "+", "\u00a0": " ", "\u2009": " ", "\u202f": " ",
    "\u200b": "", "\u200c": "", "\u200d": "", "\u2060": "", "\ufeff": "", "\u00ad": "",
}
# The digits 0 to 9 in words, by language.
SPELLED = (
    "zero one two three four five six seven eight nine",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
)
DIGIT_WORDS = {w: str(i) for line in SPELLED for i, w in enumerate(line.split())}
AT_WORDS = ("at", "arroba", "ät", "chez")
DOT_WORDS = ("dot", "punto", "point", "punkt")

_DIGITS_ANY = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_AT, _DOT = "|".join(AT_WORDS), "|".join(DOT_WORDS)
_OPEN, _CLOSE = r"[(\[{<]", r"[)\]}>]"
_SIGNS = re.compile(rf"{_OPEN}\s{{0,3}}(?:{_AT}|{_DOT}|@|\.)\s{{0,3}}{_CLOSE}|\s@|@\s", re.I)


_WORD = re.compile(r"\w+")
_HINTS = frozenset((*DIGIT_WORDS, *DOT_WORDS, "plus"))
# what re.I takes for an ASCII letter, but lower() doesn't
_FOLDED = {0x130: "i", 0x131: "i", 0x17F: "s"}


def _lowered(text: str) -> str:
    """Lower case as re.I compares letters."""
    return text.lower() if text.isascii() else text.translate(_FOLDED).lower()


def _hinted(text: str) -> bool:
    """Whether a text may hold something disguised by words or signs: True wherever ``_WORDS`` finds
    anything. Its signs are in ``_SIGNS``; all else but a lone "at", which needs a dot, has a whole
    word of ``_HINTS``."""
    if any(c in text for c in "([{<@") and _SIGNS.search(text):
        return True
    return not _HINTS.isdisjoint(_WORD.findall(_lowered(text)))


_WORDS = re.compile(
    rf"(?P<at>\s{{0,3}}{_OPEN}\s{{0,3}}(?:{_AT}|@)\s{{0,3}}{_CLOSE}\s{{0,3}}"
    rf"|(?<=[A-Za-z0-9])\s{{1,3}}@\s{{0,3}}(?=[A-Za-z0-9])|@\s{{1,3}}(?=[A-Za-z0-9])"
    rf"|(?<=[A-Za-z0-9])\s{{1,3}}(?:{_AT})\s{{1,3}}(?=[A-Za-z0-9-]+(?:\s{{1,3}}(?:{_DOT})\s|\s{{0,3}}{_OPEN}\s{{0,3}}(?:{_DOT}|\.))))"
    rf"|(?P<dot>\s{{0,3}}{_OPEN}\s{{0,3}}(?:{_DOT}|\.)\s{{0,3}}{_CLOSE}\s{{0,3}}|(?<=[A-Za-z0-9])\s{{1,3}}(?:{_DOT})\s{{1,3}}(?=[A-Za-z0-9]))"
    rf"|(?P<plus>\bplus\s{{1,3}}(?=(?:{_DIGITS_ANY}|[0-9])))"
    rf"|(?P<digit>\b(?:{_DIGITS_ANY})\b(?P<gap>[\x20\t-]{{1,3}}(?=(?:{_DIGITS_ANY})\b))?)", re.I)


def _ascii(c: str) -> str | None:
    """What a character beyond ASCII looks like, if anything."""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if "！" <= c <= "～":
        return chr(ord(c) - 0xFEE0)
    digit = unicodedata.decimal(c, None)
    return None if digit is None else str(digit)


_CLASS = "".join(re.escape(c) for c in LOOKALIKES) + "！-～"
_STRANGE = re.compile(f"[{_CLASS}]|(?![0-9])\\d")


def _strange(text: str) -> bool:
    """Whether a text holds a look-alike; of the first 256 characters two are in the table."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _STRANGE.search(text) is not None
    return "\xa0" in text or "\xad" in text


class Traced:
    """A text with, for every character, the source characters [start, end) it stands for."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, range(len(text)), range(1, len(text) + 1)

    def rewrite(self, rule: re.Pattern, put) -> None:
        """Replace what ``rule`` finds by ``put(match)``; None leaves it."""
        pieces, start, end, done = [], [], [], 0
        for m in rule.finditer(self.text):
            new = put(m)
            if new is None:
                continue
            a, b = m.span()
            pieces += [self.text[done:a], new]
            start += [*self.start[done:a], *[self.start[a]] * len(new)]
            end += [*self.end[done:a], *[self.end[b - 1]] * len(new)]
            done = b
        if pieces:
            self.text = "".join(pieces) + self.text[done:]
            self.start, self.end = start + list(self.start[done:]), end + list(self.end[done:])


def _word(m: re.Match) -> str:
    if m.lastgroup == "at" or m.group("at") is not None:
        return "@"
    if m.group("dot") is not None:
        return "."
    if m.group("plus") is not None:
        return "+"
    return DIGIT_WORDS[_lowered(m.group("digit")[:len(m.group("digit")) - len(m.group("gap") or "")])]


def disguised_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that only the rewritten text shows, in places of the source. One that meets spans of
    ``base`` counts only if they are parts of it, of its kind."""
    strange = not text.isascii() and _strange(text)
    if not strange and not _hinted(text):
        return []
    traced = Traced(text)
    if strange:
        traced.rewrite(_STRANGE, lambda m: _ascii(m.group()))
    traced.rewrite(_WORDS, _word)
    taken, out, k = sorted((a, b, kind) for kind, a, b in base), [], 0
    for kind, a, b in base_spans(traced.text):
        # blanks that a rewritten sign has swallowed are inside the span; none stands at its ends
        a, b = traced.start[a], traced.end[b - 1]
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        met, i = [], k
        while i < len(taken) and taken[i][0] < b:
            if taken[i][1] > a:
                met.append(taken[i])
            i += 1
        # of what was found as written, only a part of the same kind may be inside
        if all(a <= x and y <= b and other == kind and (a, b) != (x, y) for x, y, other in met):
            out.append((kind, a, b))
    return out


# ---------------------------------------------------------------------------
# Operators
# ---------------------------------------------------------------------------

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _texts(column: pa.Array):
    """The texts one by one, so that only one is a Python string at a time."""
    return (x.as_py() or "" for x in column)


def _listed(spans) -> list[dict]:
    return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, base (spans as written) and added (spans that were disguised), each ordered by
    start, then kind as in ``KINDS``."""
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("base", T.ArrayType(SPAN)),
                           T.StructField("added", T.ArrayType(SPAN))])

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            base = [base_spans(t) for t in _texts(batch.column(1))]
            added = [disguised_spans(t, b) for t, b in zip(_texts(batch.column(1)), base, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_listed(x) for x in base], _ARROW),
                                              pa.array([_listed(x) for x in added], _ARROW)], ["id", "base", "added"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def masked(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    base = base_spans(text)
    pieces, done = [], 0
    for kind, a, b in sorted(base + disguised_spans(text, base), key=lambda x: (x[1], x[0])):
        if a >= done:
            pieces += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join(pieces) + text[done:]


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with personal data masked in the text; a null text stays null."""
    ship_package(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            new = pa.array([None if x.as_py() is None else masked(x.as_py()) for x in batch.column(at)], batch.column(at).type)
            yield batch.set_column(at, batch.schema.field(at), new)

    return docs.mapInArrow(run, docs.schema)
