"""Secret scans: fixed patterns, and a character network over every other candidate.

The network slides over whole texts; a candidate is judged by the strongest answers in it and in the
context on either side, whatever its length. It learns from all findings of the patterns and from
all candidates that no pattern matches; its threshold is the highest that still finds the asked
share of findings set aside for that.

Examples are dealt by their hash to shards of bounded size, the same whatever the partitions. A
network is started on one shard; every shard then goes on from there with its own examples, and the
mean of what the shards come to, by their numbers of examples, is the network.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import by_task, pick, written
from pointloom.llm.spans import Span, by_start, digest, joined, masked

# Kinds of findings and their patterns.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_ASSIGN_WORDS = ("passw", "secret", "token", "api_key", "apikey")

# What the network adds.
LEARNED = "model"
ALL_KINDS = (*KINDS, LEARNED)

# A candidate: a run of the characters of assigned values, as long as the shortest of those.
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")

# Characters of texts for each shard of examples, and bytes of examples that a task deals at once.
SHARD, DEALT = 1 << 21, 1 << 24
# Of a part of an example with more places than these, what repeats is left out.
INSIDE = 256
# Places of a part that are compared together, a power of two.
WIDE = 16
# Characters of context on either side.
AROUND = 16
CLASSES, FILTERS, SPAN = 12, 24, 5
# Passes over the shard that the network starts on, and at least so many steps; rates there, and
# where all shards go on.
EPOCHS, STEPS, RATE, ON_RATE = 8, 200, 0.01, 0.002
# Examples of the label that has more in a step: least and most of them there, and where all go on.
BATCH, MOST, ON_BATCH = 64, 256, 1024
# Places of examples that are convolved together and of texts that are judged together, and texts
# of which that is done at most.
PLACES, TEXTS = 1 << 17, 256
# Places whose answers are held at once, and the longest run of them with its strongest at hand.
BLOCK, RUN = 1 << 12, 16
_RUNS = 2 ** np.arange(RUN.bit_length())


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind; too short ones are dropped.

    A whole run either reaches its least length or does not, so the least lengths of keys and
    digests are in their patterns; that of an assigned value is tested after the match.
    """
    found = []
    lower = text.lower()
    if any(w in lower for w in _ASSIGN_WORDS):
        found += [
            Span("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 8
        ]
    if "AKIA" in text:
        found += [Span("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [Span("hex", *m.span()) for m in _HEX.finditer(text)]
    return by_start(found, KINDS)


def candidates(text: str) -> list[Span]:
    """Every token that could be a secret."""
    return [Span(LEARNED, *m.span()) for m in _RUN.finditer(text)]


def touching(spans: list[Span], others: list[Span]) -> np.ndarray:
    """Which of some spans, in order and apart, overlap any of the others."""
    starts = np.array([s.start for s in spans], np.int64)
    ends = np.array([s.end for s in spans], np.int64)
    edges = sorted((o.start, o.end) for o in others)
    begun = np.array([a for a, _ in edges], np.int64)
    # How far the others reach that begin before a span ends.
    reach = np.maximum.accumulate(np.array([-1, *(b for _, b in edges)], np.int64))
    return reach[np.searchsorted(begun, ends, "left")] > starts


def values_of(text: str, found: list[Span]) -> list[Span]:
    """The secrets in findings: of an assignment its value, of others all."""
    return [
        s._replace(start=s.start + _ASSIGN.fullmatch(text[s.start : s.end]).start(2))
        if s.kind == "assign" else s
        for s in found
    ]


# Character classes: lower, upper, digit, and others by what they do in code and prose.
_CLASS = np.full(128, 11, np.int8)
for _chars, _n in (
    ("ghijklmnopqrstuvwxyz", 1), ("abcdef", 2), ("GHIJKLMNOPQRSTUVWXYZ", 3), ("ABCDEF", 4),
    ("0123456789", 5), (" \t\r\n", 6), ("=:", 7), ("\"'`", 8), ("+/_-", 9), (".,;@", 10),
):
    _CLASS[[ord(c) for c in _chars]] = _n


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _CLASS[np.minimum(codes, 127)]


class Network(NamedTuple):
    """One layer of filters over character classes, the strongest answer of each in the
    context before, in the candidate and in the context after, and a logistic unit; ``threshold``
    is on its probability after calibration by ``scale`` and ``shift``."""

    filters: np.ndarray  # SPAN x CLASSES x FILTERS
    offsets: np.ndarray  # FILTERS
    weights: np.ndarray  # PARTS * FILTERS + 1
    scale: float
    shift: float
    threshold: float

    def logits(self, texts: list[np.ndarray], spans: list[list[Span]]) -> np.ndarray:
        """Of the spans of all texts, in order; texts are given by classes.

        Filters slide over whole texts, laid end to end: each place is convolved once, for
        all candidates around it, and a candidate of any length has all its places.
        """
        pad = np.zeros(AROUND + SPAN, np.int8)
        line = np.concatenate([pad, *(x for t in texts for x in (t, pad))])
        begins = np.cumsum([len(pad), *(len(t) + len(pad) for t in texts)])
        edges = [
            (begin + s.start, begin + s.end) for begin, some in zip(begins.tolist(), spans) for s in some
        ]
        if not edges:
            return np.zeros(0)
        start, end = np.array(edges, np.int64).T
        return self._pooled(line.astype(np.int64), start, end) @ self.weights[:-1] + self.weights[-1]

    def _pooled(self, line: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        three, two = _answer_tables(self.filters.astype(np.float32), self.offsets.astype(np.float32))
        features = np.zeros((len(start) * PARTS, FILTERS), np.float32)
        low, high = np.array(_ranges(start, end)).transpose(1, 0, 2).reshape(2, -1)
        # Ranges go in pieces that two runs of ``RUN`` cover, and pieces in blocks of bounded length.
        n = -(-(high - low) // (2 * RUN))
        row = np.repeat(np.arange(len(low)), n)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        low, high = low[row] + piece * 2 * RUN, high[row]
        high = np.minimum(high, low + 2 * RUN)
        order = np.argsort(low, kind="stable")
        row, low, high = row[order], low[order], high[order]
        whole = n[row] == 1
        level = np.searchsorted(_RUNS, high - low, "right") - 1
        at = 0
        while at < len(low):
            stop = int(np.searchsorted(low, low[at] + BLOCK, "left"))
            base, top = int(low[at]), int(high[at:stop].max())
            c = line[base : top + SPAN - 1]
            # The strongest answers of runs of 1, 2, 4, ... places, by the place where they begin.
            best = np.take(three, (c[:-4] * CLASSES + c[1:-3]) * CLASSES + c[2:-2], axis=0)
            best += np.take(two, c[3:-1] * CLASSES + c[4:], axis=0)
            found = np.empty((stop - at, FILTERS), np.float32)
            for k, run in enumerate(_RUNS.tolist()):
                if k:
                    best = np.maximum(best[: -run // 2], best[run // 2 :])
                these = np.flatnonzero(level[at:stop] == k)
                if len(these):
                    one = np.take(best, low[at + these] - base, axis=0)
                    other = np.take(best, high[at + these] - run - base, axis=0)
                    found[these] = np.maximum(one, other, out=one)
                if len(best) <= run:
                    break
            np.maximum(found, 0, out=found)
            alone = whole[at:stop]
            features[row[at:stop][alone]] = found[alone]
            np.maximum.at(features, row[at:stop][~alone], found[~alone])
            at = stop
        return features.reshape(PARTS, len(start), FILTERS).transpose(1, 0, 2).reshape(len(start), -1)

    def probabilities(self, texts: list[np.ndarray], spans: list[list[Span]]) -> np.ndarray:
        return _sigmoid(self.scale * self.logits(texts, spans) + self.shift)


# The context before, the candidate, the context after.
PARTS = 3


def _ranges(start, end) -> list[tuple]:
    """Places at which a filter begins that touch each part."""
    return [
        (start - AROUND, start),
        (start - SPAN + 1, end),
        (end - SPAN + 1, end + AROUND - SPAN + 1),
    ]


class Example(NamedTuple):
    """Classes of a candidate between those of its context, ``AROUND`` on either side."""

    classes: np.ndarray
    label: int


def padded(classes: np.ndarray) -> bytes:
    """Classes between as much of nothing as a context has."""
    return bytes(AROUND) + classes.tobytes() + bytes(AROUND)


def example_of(line: bytes, span: Span) -> bytes:
    """A candidate with its context, from the :func:`padded` classes of its text."""
    return line[span.start : span.end + 2 * AROUND]


def _judged(network: Network, examples: list[Example]) -> np.ndarray:
    """Logits of examples, as of texts that hold nothing else."""
    if not examples:
        return np.zeros(0)
    three, two = _answer_tables(network.filters.astype(np.float32), network.offsets.astype(np.float32))
    found = []
    for at, stop, lines, begins in _blocks(_parts([e.classes for e in examples])):
        head, tail = np.divmod(lines.T, CLASSES * CLASSES)
        best = _strongest(np.take(three, head, axis=0) + np.take(two, tail, axis=0))
        features = np.maximum(np.maximum.reduceat(best, begins, axis=0), 0).reshape(stop - at, -1)
        found.append(features @ network.weights[:-1] + network.weights[-1])
    return np.concatenate(found)


class _Parts(NamedTuple):
    """Places of the parts of examples as the numbers of the classes a filter sees there, in lines
    of ``WIDE``; a part that fills its last line in part has its last place there several times."""

    lines: np.ndarray
    begins: np.ndarray  # of the parts, PARTS an example, and the end

    def of(self, rows: np.ndarray) -> _Parts:
        parts = (rows[:, None] * PARTS + np.arange(PARTS)).ravel()
        sizes = (self.begins[1:] - self.begins[:-1])[parts]
        begins = np.append(0, np.cumsum(sizes))
        at = np.arange(begins[-1]) + np.repeat(self.begins[parts] - begins[:-1], sizes)
        return _Parts(self.lines[at], begins)


def _parts(examples: list[np.ndarray]) -> _Parts:
    """Parts of examples that are given by classes. The strongest answer in a part is that of the
    places that differ, so of long parts only those are held."""
    sizes = np.array([len(e) for e in examples], np.int64)
    line = np.concatenate([*examples, np.zeros(SPAN, np.int8)]).astype(np.int32)
    seen = line[: 1 - SPAN]
    for k in range(1, SPAN):
        seen = seen * CLASSES + line[k : len(line) - SPAN + 1 + k]
    begins = np.append(0, np.cumsum(sizes))[:-1]
    ranges = np.array(_ranges(begins + AROUND, begins + sizes - AROUND)).transpose(2, 0, 1).reshape(-1, 2)
    low, size = ranges[:, 0], ranges[:, 1] - ranges[:, 0]
    if (size > INSIDE).any():
        held = [seen[a : a + n] for a, n in zip(low.tolist(), size.tolist())]
        held = [np.unique(h) if len(h) > INSIDE else h for h in held]
        seen, size = np.concatenate(held), np.array([len(h) for h in held])
        low = np.cumsum(size) - size
    n = -(-size // WIDE)
    ends = np.cumsum(n)
    first = (np.arange(n.sum()) - np.repeat(ends - n, n)) * WIDE
    within = np.minimum(first[:, None] + np.arange(WIDE), np.repeat(size, n)[:, None] - 1)
    return _Parts(seen[np.repeat(low, n)[:, None] + within], np.append(0, ends))


def _blocks(parts: _Parts) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Examples, from and to, with their lines and the begins of their parts, in blocks of bounded length."""
    first, at = parts.begins[::PARTS], 0
    while at < len(first) - 1:
        stop = max(at + 1, int(np.searchsorted(first, first[at] + PLACES // WIDE, "right")) - 1)
        begins = parts.begins[at * PARTS : stop * PARTS + 1]
        yield at, stop, parts.lines[begins[0] : begins[-1]], begins[:-1] - begins[0]
        at = stop


def loss_and_gradient(state: list[np.ndarray], examples: list[Example]):
    """Mean logistic loss, and its gradient by filters, offsets and weights."""
    y = np.array([e.label for e in examples])
    return _loss_and_gradient(state, _parts([e.classes for e in examples]), y, np.full(len(y), 1 / len(y)))


def _answer_tables(filters: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What three classes and the two after them add to each filter."""
    three = filters[0][:, None, None] + filters[1][None, :, None] + filters[2][None, None] + offsets
    two = filters[3][:, None] + filters[4][None]
    return three.reshape(-1, FILTERS), two.reshape(-1, FILTERS)


def _strongest(answers: np.ndarray) -> np.ndarray:
    """The largest along the first axis, of ``WIDE``, by halves."""
    while len(answers) > 1:
        half = len(answers) // 2
        answers = np.maximum(answers[:half], answers[half:])
    return answers[0]


def _loss_and_gradient(state: list[np.ndarray], parts: _Parts, y: np.ndarray, share: np.ndarray):
    """The loss with a share for each example, and its gradient."""
    filters, offsets, weights = state
    three, two = _answer_tables(filters, offsets)
    by_three, by_two = np.zeros(three.size), np.zeros(two.size)
    loss, by_weight, column = 0.0, np.zeros(len(weights)), np.arange(FILTERS)
    for at, stop, lines, begins in _blocks(parts):
        head, tail = np.divmod(lines.T, CLASSES * CLASSES)
        answers = np.take(three, head, axis=0) + np.take(two, tail, axis=0)
        best = _strongest(answers)
        # Of equal answers of a line, which are of like places, the last.
        where = np.zeros(best.shape, np.int8)
        for k in range(1, WIDE):
            np.maximum(where, (answers[k] == best).view(np.int8) * np.int8(k), out=where)
        rows, where = np.arange(len(lines))[:, None], where.astype(np.int64)
        head, tail = head[where, rows], tail[where, rows]
        strongest = np.maximum.reduceat(best, begins, axis=0)
        features = np.maximum(strongest, 0).reshape(stop - at, -1)
        logit = features @ weights[:-1] + weights[-1]
        loss += float(share[at:stop] @ (np.logaddexp(0, logit) - y[at:stop] * logit))
        slope = share[at:stop] * (_sigmoid(logit) - y[at:stop])
        by_weight += np.append(slope @ features, slope.sum())
        back = (slope[:, None] * weights[:-1] * (features > 0)).reshape(-1, FILTERS)
        if len(lines) > len(begins):
            # And of the lines of a part the last with its strongest answer.
            sizes = np.diff(begins, append=len(lines))
            line, of = np.nonzero(best == np.repeat(strongest, sizes, axis=0))
            chosen = np.zeros(strongest.shape, np.int64)
            chosen[np.repeat(np.arange(len(begins)), sizes)[line], of] = line
            head, tail = head[chosen, column], tail[chosen, column]
        by_three += np.bincount((head * FILTERS + column).ravel(), back.ravel(), three.size)
        by_two += np.bincount((tail * FILTERS + column).ravel(), back.ravel(), two.size)
    by_three = by_three.reshape(CLASSES, CLASSES, CLASSES, FILTERS)
    by_two = by_two.reshape(CLASSES, CLASSES, FILTERS)
    by_filter = np.stack([
        by_three.sum((1, 2)), by_three.sum((0, 2)), by_three.sum((0, 1)), by_two.sum(1), by_two.sum(0),
    ])
    return loss, [by_filter, by_filter[0].sum(0), by_weight]


def _some_state(seed: int) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    return [
        rng.normal(0, 0.3, (SPAN, CLASSES, FILTERS)),
        np.zeros(FILTERS),
        rng.normal(0, 0.3, PARTS * FILTERS + 1),
    ]


def learned(
    state: list[np.ndarray], examples: list[list[bytes]], passes: int, steps: int, batch: int, rate: float, seed: int
) -> list[np.ndarray]:
    """The state after some passes over the examples of both labels, and at least some steps.

    A step has so many examples of the label that has more. A pass has every example. Of the label with fewer each step has some, over and over; both
    labels count alike.
    """
    state = [x.astype(np.float32) for x in state]
    sizes = [len(e) for e in examples]
    if not min(sizes):
        return state
    parts = [_parts([np.frombuffer(e, np.int8) for e in some]) for some in examples]
    more = int(sizes[1] > sizes[0])
    rng = np.random.default_rng(seed)
    n = math.ceil(sizes[more] / batch)
    fewer = max(math.ceil(sizes[1 - more] / n), math.ceil(sizes[more] / n) // 16)
    first, second = [np.zeros_like(x) for x in state], [np.zeros_like(x) for x in state]
    step = 0
    for _ in range(max(passes, math.ceil(steps / n))):
        others = np.resize(rng.permutation(sizes[1 - more]), (n, fewer))
        for rows, other in zip(np.array_split(rng.permutation(sizes[more]), n), others):
            one, two = parts[more].of(rows), parts[1 - more].of(other)
            both = _Parts(
                np.concatenate((one.lines, two.lines)),
                np.concatenate((one.begins, one.begins[-1] + two.begins[1:])),
            )
            y = np.repeat(np.array([more, 1 - more], np.float32), [len(rows), len(other)])
            share = np.repeat(np.float32([0.5 / len(rows), 0.5 / len(other)]), [len(rows), len(other)])
            _, gradient = _loss_and_gradient(state, both, y, share)
            step += 1
            for i, g in enumerate(gradient):
                g = g.astype(np.float32)
                first[i] = np.float32(0.9) * first[i] + np.float32(0.1) * g
                second[i] = np.float32(0.999) * second[i] + np.float32(0.001) * g * g
                size = np.sqrt(second[i] / np.float32(1 - 0.999**step)) + np.float32(1e-8)
                state[i] = state[i] - np.float32(rate / (1 - 0.9**step)) * first[i] / size
    return state


def _calibrate(judged: DataFrame, clean: int, findings: int) -> tuple[float, float]:
    """Scale and shift of a logistic curve over ``logit`` by ``label``, by Newton's steps, with
    smoothed targets."""
    logit = F.col("logit")
    target = F.when(F.col("label") == 1, (findings + 1) / (findings + 2)).otherwise(1 / (clean + 2))
    curve = np.array([1.0, 0.0])
    for _ in range(20):
        line = F.least(F.lit(50.0), F.greatest(F.lit(-50.0), logit * float(curve[0]) + float(curve[1])))
        p = 1 / (1 + F.exp(-line))
        rows = judged.select(logit, (target - p).alias("rest"), (p * (1 - p)).alias("bend"))
        sums = rows.agg(
            F.sum(F.col("rest") * logit), F.sum("rest"),
            F.sum(F.col("bend") * logit * logit), F.sum(F.col("bend") * logit), F.sum("bend"),
        ).first()
        hessian = np.array([[sums[2], sums[3]], [sums[3], sums[4]]]) + 1e-3 * np.eye(2)
        move = np.clip(np.linalg.solve(hessian, np.array(sums[:2])), -1, 1)
        curve = curve + move
        if np.abs(move).max() < 1e-9:
            break
    return max(float(curve[0]), 1e-3), float(curve[1])


def _smallest(values: DataFrame, rank: int) -> float:
    """The value of ``logit`` that ``rank`` rows precede in order, by counts of ever finer steps."""
    for bits in (2, 12, 22):
        step = F.floor(F.col("logit") * float(1 << bits))
        counts = sorted(values.groupBy(step.alias("step")).count().collect())
        for at, n in counts:
            if rank < n:
                break
            rank -= n
        values = values.filter(step == at)
    for value, n in sorted(values.groupBy("logit").count().collect()):
        if rank < n:
            return value
        rank -= n
    raise ValueError("fewer rows than the rank")


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -50, 50)))


# Between the examples of a blob; no class.
_END = b"\xff"
# States are summed as whole numbers of this fraction, in whatever order.
_UNIT = float(1 << 32)
_BLOBS = ("fit_0", "fit_1", "aside_0", "aside_1")


def _packed(examples: list[bytes]) -> bytes:
    return zlib.compress(_END.join(examples), 1) if examples else b""


def _unpacked(blob: bytes) -> list[bytes]:
    return zlib.decompress(blob).split(_END) if blob else []


def examples_of(docs: DataFrame, seed: int = 11) -> DataFrame:
    """All distinct examples of all documents, a row per shard: of those to fit and those set
    aside, by label, a blob and, as ``n_...``, their number.

    Candidates that touch the secret in a finding of the patterns are labelled findings, those that
    touch no finding are not; what only touches the word before a value is left out. A copied
    example counts once. A quarter is set aside, by hash.
    """
    texts = pick(docs, "text").filter(F.col("text").isNotNull())
    chars = texts.agg(F.sum(F.char_length("text").cast("long"))).first()[0] or 0
    shards = max(1, math.ceil(chars / SHARD))

    def deal(held: tuple[set[bytes], set[bytes]]) -> dict[str, object]:
        dealt = defaultdict(list)
        for label, some in enumerate(held):
            for example in some:
                dealt[xxhash.xxh64_intdigest(example, seed) % shards, label].append(example)
            some.clear()
        return {
            "shard": [shard for shard, _ in dealt],
            "label": [label for _, label in dealt],
            "blob": [_packed(some) for some in dealt.values()],
        }

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        held, size = (set(), set()), 0
        for batch in batches:
            for text in batch["text"].to_pylist():
                some = candidates(text)
                if not some:
                    continue
                base, line = base_spans(text), padded(classes_of(text))
                size += len(line)
                if not base:
                    held[0].update([line[a : b + 2 * AROUND] for _, a, b in some])
                else:
                    found = touching(some, values_of(text, base)).tolist()
                    for span, label, other in zip(some, found, touching(some, base).tolist()):
                        if label or not other:
                            held[int(label)].add(example_of(line, span))
                if size >= DEALT:
                    yield deal(held)
                    size = 0
        yield deal(held)

    def gather(rows: pa.Table) -> pa.Table:
        every = (set(), set())
        for label, blob in zip(rows["label"].to_pylist(), rows["blob"].to_pylist()):
            every[label].update(_unpacked(blob))
        found = {}
        for label, some in enumerate(every):
            aside = {e for e in some if xxhash.xxh64_intdigest(e, seed + 1) % 4 == 0}
            found[f"fit_{label}"], found[f"aside_{label}"] = sorted(some - aside), sorted(aside)
        columns = {"shard": pa.array(rows["shard"].to_pylist()[:1], pa.int64())}
        columns |= {f"n_{name}": pa.array([len(found[name])], pa.int64()) for name in _BLOBS}
        return pa.table(columns | {name: pa.array([_packed(found[name])], pa.binary()) for name in _BLOBS})

    dealt = by_task(texts, "shard long, label int, blob binary", convert)
    counts = ", ".join(f"n_{name} long" for name in _BLOBS)
    blobs = ", ".join(f"{name} binary" for name in _BLOBS)
    gathered = dealt.groupBy("shard").applyInArrow(gather, f"shard long, {counts}, {blobs}")
    return written(gathered, "examples")


def _mean_state(shards: DataFrame, learn: Callable[[dict], list[np.ndarray]]) -> list[np.ndarray]:
    """The mean of the states that shards come to, by their numbers of examples."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                n = row["n_fit_0"] + row["n_fit_1"]
                flat = np.concatenate([x.ravel() for x in learn(row)]).astype(float)
                yield {"n": [n], "state": [np.rint(flat * _UNIT).astype(np.int64) * n]}

    states = by_task(shards, "n long, state array<long>", convert)
    values = states.select("n", F.posexplode("state").alias("at", "value"))
    sums = values.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")), F.sum("n")).collect()
    flat = np.array([int(value) / (n * _UNIT) for _, value, n in sorted(sums)])
    like = _some_state(0)
    cuts = np.cumsum([x.size for x in like])[:-1]
    return [part.reshape(x.shape) for part, x in zip(np.split(flat, cuts), like)]


def fit(docs: DataFrame, recall: float = 0.95, seed: int = 11) -> Network | None:
    """A network fitted on all distinct examples of all documents, see :func:`examples_of`.

    It starts on the shard with most findings; all shards go on from there, and their mean is
    taken. Calibration, a logistic curve over the logits, and the threshold come from all that
    is set aside: it is the largest with which at least ``recall`` of those findings are found. A
    label of which nothing is left to fit or set aside is used whole for both. None where one label
    has no example. The driver receives sums, and of two shards the examples.
    """
    shards = examples_of(docs, seed)
    total = shards.agg(*[F.coalesce(F.sum(f"n_{name}"), F.lit(0)).alias(name) for name in _BLOBS]).first()
    if not all(total[f"fit_{label}"] + total[f"aside_{label}"] for label in (0, 1)):
        return None
    # Blobs of each label that are fitted, and that are judged.
    scarce = [not (total[f"fit_{label}"] and total[f"aside_{label}"]) for label in (0, 1)]
    fitted = [[f"fit_{k}", f"aside_{k}"] if scarce[k] else [f"fit_{k}"] for k in (0, 1)]
    judging = [[f"fit_{k}", f"aside_{k}"] if scarce[k] else [f"aside_{k}"] for k in (0, 1)]

    def having(row: dict, names: list[str]) -> list[bytes]:
        return [e for name in names for e in _unpacked(row[name])]

    def most(label: int) -> dict:
        n = sum((F.col(f"n_{name}") for name in fitted[label]), F.lit(0))
        return shards.orderBy(n.desc(), "shard").first().asDict()

    # Shards without examples of a label borrow those of the shard that has most.
    richest = [most(label) for label in (0, 1)]
    spare = [{name: richest[k][name] for name in fitted[k]} for k in (0, 1)]

    def learning(state: list[np.ndarray], passes: int, steps: int, batch: int, rate: float):
        def learn(row: dict) -> list[np.ndarray]:
            examples = [having(row, fitted[k]) or having(spare[k], fitted[k]) for k in (0, 1)]
            return learned(state, examples, passes, steps, batch, rate, seed)

        return learn

    start = shards.filter(F.col("shard") == richest[1]["shard"])
    batch = min(MOST, max(BATCH, max(row[f"n_{name}"] for row in richest for name in _BLOBS) // 128))
    state = _mean_state(start, learning(_some_state(seed), EPOCHS, STEPS, batch, RATE))
    if not shards.filter(F.col("shard") != richest[1]["shard"]).isEmpty():
        state = _mean_state(shards, learning(state, 1, 1, ON_BATCH, ON_RATE))
    network = Network(*state, 1.0, 0.0, 0.5)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                for label in (0, 1):
                    some = [Example(np.frombuffer(e, np.int8), label) for e in having(row, judging[label])]
                    yield {"label": np.full(len(some), label, np.int32), "logit": _judged(network, some)}

    judged = written(by_task(shards, "label int, logit double", judge), "judged")
    counts = [total[f"aside_{k}"] + scarce[k] * total[f"fit_{k}"] for k in (0, 1)]
    scale, shift = _calibrate(judged, *counts)
    least = _smallest(judged.filter("label = 1").select("logit"), math.floor((1 - recall) * counts[1])) - 1e-9
    return Network(*state, scale, shift, float(_sigmoid(np.float64(scale * least + shift))))


def scanner(network: Network | None) -> Callable[[list[str]], list[tuple[list[Span], list[Span]]]]:
    """A function from texts to the spans of the patterns, and all spans: these and the
    candidates that touch none of them and that the network calls secrets."""

    def scan(texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        base = [base_spans(t) for t in texts]
        if network is None:
            return [(b, b) for b in base]
        others = []
        for text, found in zip(texts, base):
            some = candidates(text)
            apart = ~touching(some, found) if some else ()
            others.append([c for c, is_one in zip(some, apart) if is_one])
        judged = [i for i, some in enumerate(others) if some]
        classes = [classes_of(texts[i]) for i in judged]
        yes = network.probabilities(classes, [others[i] for i in judged]) >= network.threshold
        answers = iter(yes.tolist())
        more = [[c for c in some if next(answers)] for some in others]
        return [(b, by_start([*b, *m], ALL_KINDS)) for b, m in zip(base, more)]

    def scan_all(texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        found, some, size = [], [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= PLACES or len(some) >= TEXTS:
                found += scan(some)
                some, size = [], 0
        return found + scan(some)

    return scan_all


def scanned(docs: DataFrame, network: Network | None) -> DataFrame:
    """For every document: ``doc_id``, the number of findings per kind of pattern,
    ``base_sha256`` and ``base`` (their spans) and ``spans`` (with what the network adds).

    Null and empty texts have none. Texts are scanned whole, copies alike.
    """
    texts = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
    )

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        scan = scanner(network)
        for batch in batches:
            found = scan(batch["text"].to_pylist())
            yield {
                "doc_id": batch["doc_id"],
                **{
                    f"n_{kind}": [sum(s.kind == kind for s in base) for base, _ in found]
                    for kind in KINDS
                },
                "base_sha256": [digest(base) for base, _ in found],
                "spans": [joined(spans) for _, spans in found],
            }

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return by_task(texts, f"doc_id long, {counts}, base_sha256 string, spans string", convert)


def masked_documents(docs: DataFrame, network: Network | None, mask: str = "[secret]") -> DataFrame:
    """The rows of ``docs``, all columns, every found secret in ``text`` replaced by ``mask``.

    ``n_chars``, where there is such a column, follows the new text. Other texts stay as they
    are, null ones null.
    """

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scan = scanner(network)
        for texts in batches:
            found = scan([t or "" for t in texts])
            yield pd.Series(
                [None if t is None else masked(t, spans, mask) for t, (_, spans) in zip(texts, found)],
                dtype=object,
            )

    names = [f"__column_{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    changed = docs.toDF(*names).withColumn(text, clean(F.col(text)))
    if "n_chars" in docs.columns:
        n_chars = names[docs.columns.index("n_chars")]
        kind = changed.schema[n_chars].dataType
        length = F.when(F.col(text).isNull(), F.col(n_chars)).otherwise(F.char_length(text))
        changed = changed.withColumn(n_chars, length.cast(kind))
    return changed.toDF(*docs.columns)
