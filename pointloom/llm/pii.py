"""Personal data in plain and in disguised spelling, with spans of the source text.

A transducer rewrites look-alike letters, spelled digits and at/dot disguises and keeps
for every piece of its output the piece of input it stands for. The patterns run on the
source text (base findings) and on the output; what only the output shows is mapped back.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import by_task, pick
from pointloom.llm.spans import Span, by_kind, digest, joined

# Kinds of findings, their patterns and limits.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]")
CARD_DIGITS, PHONE_DIGITS = range(13, 20), range(9, 16)

# Digits from nought to nine as words.
SPELLED = (
    ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"),
    ("null", "eins", "zwei", "drei", "vier", "fünf", "sechs", "sieben", "acht", "neun"),
    ("zéro", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"),
    ("cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve"),
)
# Letters of other scripts and the Latin ones that they look like.
LOOK_ALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s",
    "ј": "j", "һ": "h", "ԁ": "d", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H",
    "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ѕ": "S", "Ј": "J",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E",
    "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "ı": "i", "ſ": "s", "ɡ": "g", "﹫": "@", "․": ".", "。": ".", "·": ".",
    "−": "-", "­": "", "﻿": "", "⁠": "",
}


def _look_alikes() -> dict[str, str]:
    table = dict(LOOK_ALIKE)
    table |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}  # full-width forms
    for zero in (0x0660, 0x06F0, 0x0966):  # digits of other scripts
        table |= {chr(zero + d): str(d) for d in range(10)}
    table |= {chr(0x1D7CE + i): str(i % 10) for i in range(50)}  # mathematical digits
    table |= {chr(c): "-" for c in range(0x2010, 0x2016)}
    table |= {chr(c): "" for c in range(0x200B, 0x2010)}  # without width
    table |= {chr(c): " " for c in [0xA0, 0x202F, 0x3000, *range(0x2000, 0x200B)]}
    return table


_ALIKE = _look_alikes()
_ODD = re.compile("[" + "".join(map(re.escape, _ALIKE)) + "]")
_DIGIT_OF = {word: str(i) for words in SPELLED for i, word in enumerate(words)} | {"oh": "0"}
_WORD = "(?:" + "|".join(sorted(_DIGIT_OF, key=len, reverse=True)) + ")"
_OPEN, _SHUT = r"\s?[\[({<]\s?", r"\s?[\])}>]\s?"
_PLAIN_DOT = r"\s{1,3}(?:dot|punto|point|punkt)\s{1,3}"
_DOT = rf"(?:{_OPEN}(?:dot|punto|point|punkt|\.){_SHUT}|{_PLAIN_DOT})"
_BEFORE = "|".join(
    [rf"(?<=[0-9][\x20()-]{{{n}}})" for n in (1, 2, 3)]
    + [rf"(?<=\b{word}\.)" for word in _DIGIT_OF]
    + [r"(?<=[0-9]\.)", r"(?<=\+)"]
)
# After an at that stands for @ no other @ follows the same name.
_NO_LOCAL = rf"(?![A-Za-z0-9._%+-]++(?:{_DOT}[A-Za-z0-9._%+-]++)*+@)"
_HOST = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_DISGUISE = re.compile(
    rf"(?P<digits>(?<!\w){_WORD}(?:[\s,-]{{1,3}}{_WORD})+(?!\w))"
    rf"|(?P<at>{_OPEN}(?:at|a|arroba|@){_SHUT}{_NO_LOCAL}"
    rf"|(?<=\w)\s{{1,3}}(?:at|arroba)\s{{1,3}}(?=[A-Za-z0-9-]+{_DOT}[A-Za-z0-9]){_NO_LOCAL}|&(?:\#0*64|\#x40|commat);|%40)"
    rf"|(?P<bare>(?<=\w)\s{{1,3}}at\s{{1,3}}(?={_HOST}){_NO_LOCAL})"
    rf"|(?P<dot>(?<=\w){_DOT}(?=\w)|&(?:\#0*46|\#x2e|period);|%2e)"
    rf"|(?P<plus>(?<!\w)plus\s{{1,3}}(?={_WORD}[\s,-]))"
    r"|(?P<letter>(?<=[0-9])[OoIl](?=[0-9]))",
    re.IGNORECASE,
)

# One spelled digit beside a digit or between dots; for text without the other disguises.
_ONE = re.compile(
    rf"(?<!\w)(?:{_WORD}(?!\w)(?=[\x20()-]{{1,3}}[0-9]|\.(?:[0-9]|{_WORD}(?!\w)))"
    rf"|(?={_WORD}(?!\w))(?:{_BEFORE}){_WORD})",
    re.IGNORECASE,
)

# What a disguise cannot do without, quicker to look for.
_PARTING = re.compile(r"[^\w\s]")
_ASCII_PARTING = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
_SPELLED = frozenset(word.encode() for word in _DIGIT_OF)
_DOTS = frozenset((b"dot", b"punto", b"point", b"punkt"))
_BRACKETED = re.compile(rf"{_OPEN[3:]}(?:at|a|arroba|@|dot|punto|point|punkt|\.)\s?[\])}}>]", re.I)
_LETTER = re.compile(r"[0-9][OoIl][0-9]")
_BARE = re.compile(r"(?i:at)\s{1,3}[A-Za-z0-9-]+\.[A-Za-z0-9]")
_CODED = re.compile(r"&(?:\#|commat|period)|%40|%2e", re.I)


class Output(NamedTuple):
    """Normalised text and its pieces: where each begins there, and its source span."""

    text: str
    begins: list[int]
    sources: list[tuple[int, int, bool]]  # start, end, rewritten

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """The source span of an output span, and whether a rewritten piece is in it."""
        i, j = bisect_right(self.begins, start) - 1, bisect_right(self.begins, end - 1) - 1
        a, _, changed = self.sources[i]
        first = a if changed else a + start - self.begins[i]
        a, b, changed = self.sources[j]
        last = b if changed else a + end - self.begins[j]
        return first, last, any(s[2] for s in self.sources[i : j + 1])


class _Tape:
    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.begins: list[int] = []
        self.sources: list[tuple[int, int, bool]] = []
        self.length = 0

    def put(self, piece: str, start: int, end: int, rewritten: bool) -> None:
        if piece:
            self.begins.append(self.length)
            self.pieces.append(piece)
            self.sources.append((start, end, rewritten))
            self.length += len(piece)

    def output(self) -> Output:
        return Output("".join(self.pieces), self.begins, self.sources)


def _rewritten(text: str, pattern: re.Pattern, replace) -> Output | None:
    tape, done = _Tape(), 0
    for m in pattern.finditer(text):
        tape.put(text[done : m.start()], done, m.start(), False)
        tape.put(replace(m), m.start(), m.end(), True)
        done = m.end()
    if not done:
        return None
    tape.put(text[done:], done, len(text), False)
    return tape.output()


_LAST_WORD = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_NOT_PLAIN = re.compile(r"[0-9_.+%]")


def _undisguised(match: re.Match) -> str:
    kind, found = match.lastgroup, match.group()
    if kind == "digits":
        return "".join(_DIGIT_OF[w.lower()] for w in re.findall(r"\w+", found))
    if kind == "bare":
        # Before a host without disguise "at" is a word, unless no plain word comes before it.
        word = _LAST_WORD.search(match.string, max(0, match.start() - 64), match.start())
        return "@" if word and _NOT_PLAIN.search(word.group()) else found
    if kind == "letter":
        return "0" if found in "Oo" else "1"
    return {"at": "@", "dot": ".", "plus": "+"}[kind]


def may_be_disguised(text: str) -> bool:
    """False only where the disguises have no match: no spelled digit beside another or beside
    a numeral, no dot as a word, no bracketed or coded at or dot, no host after at, no letter
    between digits."""
    lower = text.lower()
    if not lower.isascii() and any(c > "\x7f" and not c.isalnum() for c in set(lower)):
        lower = _PARTING.sub(" ", lower)
    words = lower.encode().translate(_ASCII_PARTING).split()
    spelled = bytes(map(_SPELLED.__contains__, words))
    if b"\1\1" in spelled or not _DOTS.isdisjoint(words):
        return True
    at = spelled.find(1)
    while at >= 0:
        if at and words[at - 1][-1:].isdigit() or words[at + 1 : at + 2] and words[at + 1][:1].isdigit():
            return True
        at = spelled.find(1, at + 1)
    return any(p.search(text) for p in (_BRACKETED, _LETTER, _BARE, _CODED))


def normalise(text: str) -> list[Output]:
    """The transducers that change something, in order: look-alikes, then disguises in what
    they gave, then single spelled digits. Spans go back through them in reverse."""
    outputs = []
    if not text.isascii() and not _ALIKE.keys().isdisjoint(set(text)):
        outputs.append(_rewritten(text, _ODD, lambda m: _ALIKE[m.group()]))
        text = outputs[0].text
    if may_be_disguised(text):
        found = _rewritten(text, _DISGUISE, _undisguised)
        if found:
            outputs.append(found)
            text = found.text
        found = _rewritten(text, _ONE, lambda m: _DIGIT_OF[m.group().lower()])
        if found:
            outputs.append(found)
    return outputs


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The run before each @, back to the match before it, with the domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def find(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind, in order of kind and start; those that fail
    a limit are dropped as a whole."""
    found = [Span("email", *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found.append(Span("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGITS.sub("", m.group())
        if len(digits) in CARD_DIGITS and _luhn(digits):
            found.append(Span("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if len(_NOT_DIGITS.sub("", m.group())) in PHONE_DIGITS:
                found.append(Span("phone", *m.span()))
    return found


def _covers(spans: list[Span], span: Span) -> bool:
    """Whether one of the sorted spans, those of a kind apart from each other, covers it wholly."""
    at = bisect_right(spans, Span(span.kind, span.start, sys.maxsize)) - 1
    return at >= 0 and spans[at].kind == span.kind and span.end <= spans[at].end


def find_disguised(text: str, base: list[Span]) -> list[Span]:
    """Findings that only normalising shows, as spans of the source text.

    A finding without a rewritten piece in it is a base one or none; one that a base finding of
    its kind covers wholly is that one in another spelling. One that reaches beyond is added.
    """
    outputs = normalise(text)
    layers = [sorted(base)]
    # A single spelled digit may also be a word beside a finding: the text before counts too.
    for last in range(len(outputs), max(0, len(outputs) - 2), -1):
        more = []
        for kind, start, end in find(outputs[last - 1].text):
            changed = False
            for output in reversed(outputs[:last]):
                start, end, here = output.source(start, end)
                changed |= here
            span = Span(kind, start, end)
            if changed and not any(_covers(layer, span) for layer in layers):
                more.append(span)
        layers.append(sorted(more))
    return [span for layer in layers[1:] for span in layer]


def scanned(docs: DataFrame) -> DataFrame:
    """For every document: ``doc_id``, the number of base findings per kind, ``base_sha256``
    and ``spans``: these and the disguised ones.

    Null and empty texts have none. Texts are scanned whole, in linear time; extra columns
    are not read, copies give the same.
    """
    texts = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
    )

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            base = [find(t) for t in texts]
            spans = [
                by_kind([*b, *find_disguised(t, b)], KINDS)
                for t, b in zip(texts, base, strict=True)
            ]
            yield {
                "doc_id": batch["doc_id"],
                **{f"n_{k}": [sum(s.kind == k for s in b) for b in base] for k in KINDS},
                "base_sha256": [digest(b) for b in base],
                "spans": [joined(s) for s in spans],
            }

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return by_task(texts, f"doc_id long, {counts}, base_sha256 string, spans string", convert)
