"""Spans of kinds in a text, as the scanners of personal data and secrets return them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from typing import NamedTuple


class Span(NamedTuple):
    """Code points ``start`` to ``end`` (exclusive) of the source text."""

    kind: str
    start: int
    end: int


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def digest(spans: Iterable[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def by_kind(spans: Iterable[Span], kinds: Sequence[str]) -> list[Span]:
    return sorted(spans, key=lambda s: (kinds.index(s.kind), s.start, s.end))


def by_start(spans: Iterable[Span], kinds: Sequence[str]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, kinds.index(s.kind), s.end))


def masked(text: str, spans: Iterable[Span], mask: str) -> str:
    """The text with every stretch that spans cover replaced by the mask once."""
    pieces, done = [], 0
    covered = 0
    for span in sorted(spans, key=lambda s: (s.start, s.end)):
        if span.start >= covered or not pieces:
            pieces += [text[done : span.start], mask]
        done = covered = max(covered, span.end)
    return "".join([*pieces, text[done:]])
