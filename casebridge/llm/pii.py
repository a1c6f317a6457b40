"""Personal data, found in the text as written and in the text with its disguises taken off.

A transducer rewrites a text by a list of edits and keeps the way back: every position of the result is either
copied from a position of the source or stands for a source range. Two transducers run in a row. The first works
on characters (look-alike letters, full-width forms, invisible characters), the second on words (bracketed or
spelled "at" and "dot", spelled digits). Identifiers found in the result are mapped back through both.

Spans found without any edit are the base; spans that touch an edit are added unless a base span of their kind holds them.
An added span may thus hold a base one that is only a part of the identifier (an address whose local part has a
look-alike letter); masks cover the union. Positions are code points, the end is exclusive.

Null and empty texts have no spans, an empty table gives no rows, and very long texts and runs of digits are read once.
Repeated rows each get their own result; columns other than id and text are never read, so clashing names do no harm.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from string import ascii_letters, digits

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebridge.llm.tables import SPANS, span_array

KINDS = ("email", "ip", "card", "phone")

# Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = dict(
    zip(
        "аеорсухіјѕԁɡһкмтвнАВЕКМНОРСТХУІЈЅαονικρυτχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxijsdghkmtbhABEKMHOPCTXYIJSaovikputxABEZHIKMNOPTYX",
        strict=True,
    )
)
# Spelled digits.
DIGIT_WORDS = dict(zip("zero one two three four five six seven eight nine".split(), "0123456789", strict=True)) | {"oh": "0"}
INVISIBLE = "​‌‍⁠﻿­"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset(ascii_letters + digits + "._%+-")
# A match always begins a run of digits, so long runs are read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Digits of other scripts and in circles, by their value.
DIGITS = {c: str(unicodedata.digit(c)) for c in map(chr, range(128, 0x20000)) if unicodedata.digit(c, None) is not None}
# Beyond the first plane one range, sorted out afterwards: a long list of such characters would be tried one by one.
_ODD = re.compile(f"[{INVISIBLE}{''.join(LOOKALIKES)}{''.join(c for c in DIGITS if c < '\uffff')}！-～‐-―․\U00010000-\U0001ffff]")
_WORD = "(?:" + "|".join(DIGIT_WORDS) + ")"
# Between spelled digits; possessive, since no digit begins with these.
_GAP = r"(?:[\s.-]++|\s++dot\s++)"
# White space in front counts from the start of its run, for the same reason.
_BEFORE = r"(?:(?<!\s)\s+)?"
_AT = _BEFORE + r"[\[({<]\s*(?:at|@)\s*[\])}>]\s*"
_DOT = _BEFORE + r"[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*"
_WORDS = re.compile(
    rf"(?P<at>{_AT}|(?<=[a-z0-9])\s+at\s+(?=[a-z0-9-]+(?:(?:\s+dot\s+|{_DOT})[a-z0-9-]+)+))"
    rf"|(?P<dot>{_DOT}|(?<=[a-z0-9])\s+dot\s+(?=[a-z0-9]))"
    rf"|(?P<run>\b(?:plus\s+)?{_WORD}\b(?:{_GAP}(?:{_WORD}|[0-9]+)\b)+)",
    re.IGNORECASE | re.ASCII,
)
_RUN_PART = re.compile(rf"plus\s+|\s+dot\s+|{_WORD}|\s+", re.IGNORECASE | re.ASCII)
_BRACKETED = re.compile(r"[\[({<]\s*(?:at|@|dot|\.)\s*[\])}>]|\sdot\s", re.IGNORECASE)
_SPELLED = re.compile(rf"\b{_WORD}\b(?:{_GAP}(?:{_WORD}|[0-9]+)\b){{3}}", re.IGNORECASE | re.ASCII)

Span = tuple[str, int, int]
Edit = tuple[int, int, str]


class Rewritten:
    """A text after edits (in order, not overlapping), with the way back to its source."""

    def __init__(self, source: str, edits: list[Edit]) -> None:
        parts: list[str] = []
        self._starts: list[int] = []
        self._segments: list[tuple[int, int, bool]] = []
        self._size = 0

        def add(text: str, start: int, end: int, copied: bool) -> None:
            if text:
                self._starts.append(self._size)
                self._segments.append((start, end, copied))
                parts.append(text)
                self._size += len(text)

        done = 0
        for start, end, text in edits:
            add(source[done:start], done, start, True)
            add(text, start, end, False)
            done = end
        add(source[done:], done, len(source), True)
        self.text = "".join(parts)
        self.edited = [s for s in self._segments if not s[2]]

    def source_span(self, start: int, end: int) -> tuple[int, int]:
        first, last = bisect_right(self._starts, start) - 1, bisect_right(self._starts, end - 1) - 1
        a, _, copied = self._segments[first]
        source_start = a + (start - self._starts[first] if copied else 0)
        a, b, copied = self._segments[last]
        return source_start, (a + end - self._starts[last] if copied else b)


def character_edits(text: str) -> list[Edit]:
    """Look-alikes, compatibility forms and invisible characters."""
    edits = []
    for m in _ODD.finditer(text):
        c = m[0]
        if c in INVISIBLE:
            plain = ""
        elif "‐" <= c <= "―":
            plain = "-"
        else:
            plain = LOOKALIKES.get(c) or DIGITS.get(c) or unicodedata.normalize("NFKC", c)
        if plain.isascii():
            edits.append((m.start(), m.end(), plain))
    return edits


def word_edits(text: str) -> list[Edit]:
    """Bracketed and spelled "at" and "dot", and runs of spelled digits, spelled dots among them."""
    edits: list[Edit] = []
    for m in _WORDS.finditer(text):
        if m["at"]:
            edits.append((m.start(), m.end(), "@"))
        elif m["dot"]:
            edits.append((m.start(), m.end(), "."))
        else:
            for part in _RUN_PART.finditer(text, m.start(), m.end()):
                word = part[0].lower().strip()
                if word:
                    plain = {"plus": "+", "dot": "."}.get(word) or DIGIT_WORDS[word]
                else:  # spelled digits stand for one number, whatever the blanks between them
                    plain = "" if text[part.start() - 1].isalpha() and text[part.end()].isalpha() else " "
                if plain != part[0]:
                    edits.append((part.start(), part.end(), plain))
    return edits


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def identifiers(text: str) -> list[Span]:
    """Leftmost, non-overlapping identifiers of each kind, by kind and start."""
    found: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:  # an address can only begin in the run of address characters before its @
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = start < at and _DOMAIN.match(text, at + 1)
        if domain:
            done = domain.end()
            found.append(("email", start, done))
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            number = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(number) <= 19 and luhn(number):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Identifiers that only show once disguises are taken off, in source positions."""
    edits = [] if text.isascii() else character_edits(text)
    plain = Rewritten(text, edits) if edits else None
    inner = plain.text if plain else text
    word = word_edits(inner) if _BRACKETED.search(inner) or _SPELLED.search(inner) else []
    if not edits and not word:
        return []
    steps = [s for s in (Rewritten(inner, word) if word else None, plain) if s]
    touched = [(a, b) for a, b, _ in (plain.edited if plain else [])]
    if word:
        touched += [plain.source_span(a, b) if plain and b > a else (a, b) for a, b, _ in word]
    touched += [(a, b) for a, b, t in edits if not t]
    touched.sort()
    starts = [a for a, _ in touched]
    taken: dict[str, tuple[list[int], list[int]]] = {k: ([], []) for k in KINDS}
    for kind, a, b in base:  # in order, not overlapping
        taken[kind][0].append(a)
        taken[kind][1].append(b)
    added = []
    for kind, a, b in identifiers(steps[0].text):
        for step in steps:
            a, b = step.source_span(a, b)
        i = bisect_right(starts, b - 1)
        begins, ends = taken[kind]
        k = bisect_right(begins, a) - 1  # the base span that may hold this one
        if i and touched[i - 1][1] > a and not (k >= 0 and ends[k] >= b):
            added.append((kind, a, b))
    return added


def spans_of(text: str | None) -> list[tuple[str, int, int, bool]]:
    """All spans of a text by kind and start, each with whether it is a base span."""
    if not text:
        return []
    base = identifiers(text)
    more = disguised(text, base)
    every = [(*s, True) for s in base] + [(*s, False) for s in more]
    return sorted(every, key=lambda s: (KINDS.index(s[0]), s[1])) if more else every




@F.arrow_udf(SPANS)
def pii_spans(texts: pa.Array) -> pa.Array:
    return span_array(texts, spans_of)


@F.arrow_udf(T.StringType())
def mask_text(texts: pa.Array) -> pa.Array:
    return pa.array([masked(t.as_py()) for t in texts], pa.string())


def masked(text: str | None) -> str | None:
    """The text with each span, or union of overlapping ones, replaced by the kind of its first (and longest) in brackets."""
    if text is None:
        return None
    parts, done = [], 0
    for kind, a, b, _ in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
        if a >= done:
            parts += [text[done:a], f"[{kind.upper()}]"]
        elif b > done:  # runs on past the span before it: that mark stands for both
            pass
        done = max(done, b)
    return "".join([*parts, text[done:]]) if parts else text


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``spans`` (kind, start, end, base) of every row."""
    return docs.select(id_col, pii_spans(F.col(text_col)).alias("spans"))


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns, personal data in ``text_col`` replaced by marks like ``[EMAIL]``."""
    return docs.withColumn(text_col, mask_text(F.col(text_col)))
