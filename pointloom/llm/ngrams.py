"""Language-model scores from an n-gram trie in Elias-Fano levels.

Level 1 holds word hashes in order, a word's number being its place; level k holds
n-grams by the number of their first k - 1 words and, of the last word, its place among
the successors of the words in between (for bigrams the word's number). Levels are cut into
segment files in the shared folder, which tasks map into memory: nothing of them is collected or
broadcast but one row per segment. Counts, thresholds and smoothing cover all training documents.

The counts of a level tell how many tokens follow each of its entries, so they cut the next level
into segments of like size before it is counted. Tasks send their n-grams as one packed run per
chunk and segment; the task that has a segment merges the runs, sums equal n-grams and writes
pointers, successors, probabilities and what contexts leave over, all in one pass. A context with
more followers than a segment has is cut by its successors; its parts are summed on the driver.

An n-gram of count c after a context of count h gets (c - DISCOUNT) / h, and the context hands
what is left over to the next shorter one, down to words with (c + 1) / (N + V + 1). All n-grams
are kept unless ``least`` asks for more; the share of rarer ones goes to the shorter context.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import by_task, folder_of, pick, scratch_dir, utf8
from pointloom.llm.eliasfano import load, named, part, save

ORDER, LEAST_COUNT, DISCOUNT = 3, 1, 0.75
# Probabilities are kept as this many steps to a power of ten, in one byte.
STEPS = 20
# Tokens that a task looks at together, and tokens whose n-grams go into one segment file.
CHUNK_TOKENS, SEGMENT_ROWS = 1 << 20, 1 << 20
# Segments that a task has open at a time.
OPEN_SEGMENTS = 1024
# Distinct words that a task has together before it sends them.
TASK_WORDS = 1 << 21

# Bytes that are hashed together.
BLOCK_BYTES = 1 << 20
# Hashes are sums over a word's bytes times powers of an odd number, mixed; the end has one of its own.
_BASE = 0x9E3779B97F4A7C15
_END = 0x5851F42D4C957F2D
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_WHITE_BYTE = re.compile(rb"[\x20\x09-\x0D]")
_TOP = np.uint64(1 << 63)


def training_fold(doc_id: str = "doc_id", folds: int = 7, held_out: int = 2) -> Column:
    """Documents to learn from. A null id is held out."""
    fold = F.crc32(F.col(doc_id).cast("string")) % folds
    return F.coalesce(fold != held_out, F.lit(False))


class Chunk(NamedTuple):
    """Documents as tokens, end to end: ``tokens`` are places in ``words``, hashes in rising
    order. Each document closes with the end."""

    words: np.ndarray
    tokens: np.ndarray
    lengths: np.ndarray
    doc_ids: list[int | None]
    held_out: list[bool]

    def firsts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths


@lru_cache(maxsize=2)
def _powers(size: int, base: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def word_hashes(line: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of a text begins, and its hash. Words are told from the sums up to their
    edges, for all words of a block of the text at once."""
    data, at = np.frombuffer(line, np.uint8), 0
    begins, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    while at < len(data):
        stop = min(at + BLOCK_BYTES, len(data))
        if stop < len(data):  # to the next white space, so that no word is cut
            found = _WHITE_BYTE.search(line, stop)
            stop = found.start() if found else len(data)
        part = data[at:stop]
        room = max(len(part), BLOCK_BYTES)
        size = room if room == BLOCK_BYTES else 1 << room.bit_length()
        edge = np.diff((~_WHITE[part]).view(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        steps = (part + np.uint64(1)) * _powers(size, _BASE)[: len(part)]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(steps, dtype=np.uint64)))
        h = (sums[end] - sums[start]) * _powers(size, pow(_BASE, -1, 1 << 64))[start]
        h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        begins.append(at + start)
        hashes.append(h ^ h >> np.uint64(31))
        at = stop
    return np.concatenate(begins), np.concatenate(hashes)


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts, each closed by the end, and how many each text has."""
    begins, hashes = word_hashes(b" ".join(texts).lower())
    ends = np.cumsum([len(t) + 1 for t in texts])
    closed = np.searchsorted(begins, ends)
    return np.insert(hashes, closed, np.uint64(_END)), np.diff(closed, prepend=0) + 1


def chunks(
    batches: Iterator[pa.RecordBatch], most: int = CHUNK_TOKENS
) -> Iterator[Chunk]:
    """Documents together until they have ``most`` tokens."""
    hashes: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    ids: list[int | None] = []
    held: list[bool] = []
    size = 0

    def chunk() -> Chunk:
        words, place = np.unique(np.concatenate(hashes), return_inverse=True)
        return Chunk(words, place, np.concatenate(lengths), ids, held)

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("doc_id", "held_out", "text")]
        at = 0
        while at < batch.num_rows:
            # Some texts at a time, of no more bytes than a block or just one.
            stop, n_bytes = at, 0
            room = min(BLOCK_BYTES, 4 * (most - size))
            while stop < batch.num_rows and (stop == at or n_bytes + len(columns[2][stop]) <= room):
                n_bytes += len(columns[2][stop])
                stop += 1
            found, n = _tokens(columns[2][at:stop])
            hashes.append(found)
            lengths.append(n)
            ids += columns[0][at:stop]
            held += columns[1][at:stop]
            at, size = stop, size + len(found)
            if size >= most:
                yield chunk()
                hashes, lengths, ids, held, size = [], [], [], [], 0
    if hashes:
        yield chunk()


class Level(NamedTuple):
    """A level's folder, its directory there, its entries and the sum of their counts.

    The directory is a file that tasks map. It has of each segment the first key, the number of the
    first entry, how many there are and the file; of contexts that several segments
    share the first entry's number, how many entries they have and what they hand over; and
    the first keys of the segments of the next level.
    """

    folder: str
    name: str
    size: int
    total: int

    def directory(self) -> dict[str, np.ndarray]:
        system, base = folder_of(self.folder)
        return load(system, f"{base}/{self.name}")

    @property
    def segments(self) -> list[str]:
        return [name.decode() for name in self.directory()["names"]]


def _shifted(words: np.ndarray) -> np.ndarray:
    """Hashes as signed longs of the same order."""
    return (words ^ _TOP).view(np.int64)


def _routes(cuts: tuple[np.ndarray, np.ndarray], parents: np.ndarray, children: np.ndarray):
    """The segment whose range a key is in; -1 ahead of the first."""
    low, high = (np.searchsorted(cuts[0], parents, side) for side in ("left", "right"))
    at = high - 1
    shared = np.flatnonzero(high - low > 1)
    for parent in np.unique(parents[shared]).tolist():
        rows = shared[parents[shared] == parent]
        begin, end = low[rows[0]], high[rows[0]]
        within = np.searchsorted(cuts[1][begin:end], children[rows], "right")
        at[rows] = begin + np.maximum(within, 1) - 1
    return at


class Found(NamedTuple):
    """Of each question: the entry's number (-1 where there is none), its quantised value, its
    place among the successors of its context, and what the context hands over."""

    number: np.ndarray
    value: np.ndarray
    place: np.ndarray
    left: np.ndarray


class Reader:
    """Questions to a level from within a task. Segments are opened once; questions come in
    arrays and go to their segments in the order of keys."""

    def __init__(self, level: Level) -> None:
        self.system, self.base = folder_of(level.folder)
        self.opened: dict[str, dict] = {}
        found = level.directory()
        self.cuts = (found["parents"], found["children"])
        self.bases, self.sizes, self.names = found["bases"], found["sizes"], found["names"]
        self.split = tuple(found[n] for n in ("split", "split_first", "split_left"))

    def segment(self, at: int) -> dict:
        name = self.names[at].decode()
        if name not in self.opened:
            # Mapped ones take little memory; others are read, one at a time.
            if len(self.opened) >= (OPEN_SEGMENTS if self.system.type_name == "local" else 1):
                self.opened.pop(next(iter(self.opened)))
            arrays = load(self.system, f"{self.base}/{name}")
            sequences = {n.partition(".")[0] for n in arrays if "." in n}
            self.opened[name] = {
                **{n: a for n, a in arrays.items() if "." not in n},
                **{n: part(arrays, n) for n in sequences},
            }
        return self.opened[name]

    def _by_segment(self, routes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(routes, kind="stable")
        values, begins = np.unique(routes[order], return_index=True)
        for value, rows in zip(values.tolist(), np.split(order, begins[1:])):
            if value >= 0 and self.sizes[value]:
                yield value, rows

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1 for unknown ones) and count of each word, in level 1."""
        number, count = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        routes = np.searchsorted(self.cuts[0], _shifted(hashes), "right") - 1
        for at, rows in self._by_segment(routes):
            segment = self.segment(at)
            place, found = segment["keys"].find(hashes[rows])
            rows, place = rows[found], place[found]
            number[rows] = self.bases[at] + place
            count[rows] = _counts(segment, place)
        return number, count

    def entries(self, parents: np.ndarray, children: np.ndarray) -> Found:
        """Answers to distinct questions. A context that is not known hands all over."""
        n = len(parents)
        found = Found(
            np.full(n, -1), np.zeros(n, np.uint8), np.full(n, -1), np.zeros(n, np.uint8)
        )
        asked = np.flatnonzero(parents >= 0)
        for at, some in self._by_segment(_routes(self.cuts, parents[asked], children[asked])):
            rows, segment, first = asked[some], self.segment(at), self.cuts[0][at]
            rows = rows[parents[rows] - first < len(segment["left"])]
            distinct, which = np.unique(parents[rows] - first, return_inverse=True)
            found.left[rows] = segment["left"][distinct][which]
            edges = segment["pointers"].access(np.concatenate((distinct, distinct + 1)))
            begin, end = edges.astype(np.int64).reshape(2, -1)
            # Children go on rising over parents: they are counted on from the one before.
            before = segment["children"].access(np.maximum(begin - 1, 0))
            offset = np.where(begin > 0, before + np.uint64(1), np.uint64(0))
            known = (children[rows] >= 0) & (end > begin)[which]
            rows, which = rows[known], which[known]
            place, hit = segment["children"].find(children[rows].astype(np.uint64) + offset[which])
            hit &= (place >= begin[which]) & (place < end[which])
            rows, which, place = rows[hit], which[hit], place[hit]
            found.number[rows] = self.bases[at] + place
            found.value[rows] = segment["values"][place]
            found.place[rows] = place - begin[which]
        split, first, left = self.split
        if len(split):
            at = np.minimum(np.searchsorted(split, parents), len(split) - 1)
            shared = split[at] == parents
            found.left[shared] = left[at[shared]]
            shared &= found.number >= 0
            found.place[shared] = found.number[shared] - first[at[shared]]
        return found

    def counts(self, begin: int, end: int) -> np.ndarray:
        """Counts of the entries of these numbers, which follow each other."""
        found = [np.zeros(0, np.int64)]
        at = max(int(np.searchsorted(self.bases, begin, "right")) - 1, 0)
        for number in range(at, len(self.bases)):
            base, size = int(self.bases[number]), int(self.sizes[number])
            a, b = max(begin - base, 0), min(end - base, size)
            if base >= end:
                break
            if a < b:
                found.append(_counts(self.segment(number), np.arange(a, b)))
        return np.concatenate(found)


def _packed_counts(n: np.ndarray) -> dict[str, np.ndarray]:
    """A byte each; those that do not fit are told apart."""
    large = np.flatnonzero(n >= 255)
    return {
        "counts": np.minimum(n, 255).astype(np.uint8),
        "large_at": large.astype("<i8"),
        "large": n[large].astype("<i8"),
    }


def _counts(segment: dict, place: np.ndarray) -> np.ndarray:
    found = segment["counts"][place].astype(np.int64)
    large = np.flatnonzero(found == 255)
    found[large] = segment["large"][np.searchsorted(segment["large_at"], place[large])]
    return found


def _byte(probability: np.ndarray) -> np.ndarray:
    """Minus the logarithm, in steps, in a byte; what is smaller yet gets the last step."""
    logs = -np.log10(np.maximum(probability, 1e-300)) * STEPS
    return np.clip(np.rint(logs), 0, 255).astype(np.uint8)


_PROBABILITY = 10 ** (np.arange(256) / -STEPS)


def _narrow(values: np.ndarray) -> bytes:
    """Numbers from 0 in as few whole bytes each as hold all of them: all first bytes, then all
    second ones, as those of one rank are alike."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _wide(data: bytes, size: int) -> np.ndarray:
    found = np.zeros((size, 8), np.uint8)
    planes = np.frombuffer(data, np.uint8).reshape(-1, size)
    found[:, : len(planes)] = planes.T
    return found.view("<i8")[:, 0]


class Model(NamedTuple):
    """Levels 1 to ``ORDER``."""

    levels: list[Level]
    n_documents: int


class _Lookup:
    """The numbers that n-grams of a chunk's tokens have in each level."""

    def __init__(self, model: Model) -> None:
        self.levels = [Reader(level) for level in model.levels]
        # The place before a document is a context, numbered after all words.
        self.begin = model.levels[0].size

    def words(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        number, count = self.levels[0].words(chunk.words)
        return number[chunk.tokens], count[chunk.tokens]

    def climb(self, chunk: Chunk, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, Found | None]]:
        """For each level from 2 on: context and child of every token, and what the trie has
        for them; for the level that is not built yet only the former.

        A context is the number of the n-gram that ends with the token before. The child tells the
        token from others after the same context: its place among the successors of the
        context less its first token.
        """
        ends, child = words, words
        for level in range(2, len(self.levels) + 2):
            parents = np.concatenate(([-1], ends[:-1]))
            parents[chunk.firsts()] = self.begin if level == 2 else -1
            if level > len(self.levels):
                yield parents, child, None
                return
            distinct, which, _ = _distinct(parents, child)
            asked = self.levels[level - 1].entries(*distinct)
            found = Found(*(x[which] for x in asked))
            yield parents, child, found
            ends, child = found.number, found.place


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, the place of each pair among them, and how often they come."""
    if not len(a):
        return np.zeros((2, 0), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = int(b.max()) + 2
    if (int(a.max()) + 2) * width < 1 << 63:  # as one number
        keys, place, n = np.unique((a + 1) * width + b + 1, return_inverse=True, return_counts=True)
        return np.stack((keys // width - 1, keys % width - 1)), place, n
    pairs, place, n = np.unique(np.stack((a, b), 1), axis=0, return_inverse=True, return_counts=True)
    return pairs.T, place.ravel(), n


def _texts(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), (~training_fold()).alias("held_out"), utf8("text")
    )


def fit(
    docs: DataFrame,
    order: int = ORDER,
    least: int = LEAST_COUNT,
    chunk_tokens: int = CHUNK_TOKENS,
    segment_rows: int = SEGMENT_ROWS,
) -> Model:
    """Count n-grams of the training fold level by level and write their trie.

    A task counts what is in a chunk before anything is shuffled, so a frequent word is
    a row per chunk. Each level takes one exchange.
    """
    texts = _texts(docs).filter(~F.col("held_out"))
    model = _words(texts, chunk_tokens, segment_rows)
    for level in range(2, order + 1):
        model = _add_level(model, texts, least, chunk_tokens, segment_rows, last=level == order)
    return model


# What the driver gets of a segment: its range, file, size, sum and ends of documents; the contexts it shares with others
# (their entries and sums here, their count); the entries at which segments of the next level
# begin, in how many parts each is cut, and the entry's child.
_WRITTEN = (
    "first long, second long, name string, size long, total long, ends long, parents array<long>, "
    "kinds array<long>, sums array<long>, whole array<long>, at array<long>, parts array<long>, "
    "child array<long>"
)


def _next_cuts(n: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries at which segments of the next level begin, each with about ``most`` followers, and
    in how many parts an entry with more is cut."""
    if not len(n):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    piece = (np.cumsum(n) - n) // most
    hot = n > most
    begins = np.concatenate(([True], (piece[1:] != piece[:-1]) | hot[1:] | hot[:-1]))
    at = np.flatnonzero(begins)
    return at, np.maximum(-(-n[at] // most), 1)


def _words(texts: DataFrame, chunk_tokens: int, most: int) -> Model:
    """Level 1. Equal ranges of hashes go to tasks, which sum neighbours."""
    spark = texts.sparkSession
    folder = scratch_dir(spark, "level-1")
    end = np.array([_END], np.uint64)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for chunk in chunks(batches, chunk_tokens):
            n = np.bincount(chunk.tokens, minlength=len(chunk.words))
            both = [np.concatenate(x) for x in zip(held, (chunk.words, n))]
            words, place = np.unique(both[0], return_inverse=True)
            held = (words, np.bincount(place, both[1]).astype(np.int64))
            if len(words) >= TASK_WORDS:
                yield sent(*held)
                held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        yield sent(*held)

    def sent(words: np.ndarray, n: np.ndarray) -> dict[str, object]:
        part = ((words >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        return {"part": part.astype(np.int32), "h": _shifted(words), "n": n}

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        system, base = folder_of(folder)
        system.create_dir(base, recursive=True)
        held = np.zeros((3, 0), np.int64)
        for batch in batches:
            columns = (batch[c].to_numpy().astype(np.int64) for c in ("part", "h", "n"))
            held = summed(np.concatenate((held, np.stack([*columns])), axis=1))
            while held.shape[1] and (held[0, 0] != held[0, -1] or held.shape[1] > most):
                size = min(int(np.searchsorted(held[0], held[0, 0], "right")), most)
                yield segment(system, base, held[1:, :size])
                held = held[:, size:]
        if held.shape[1]:
            yield segment(system, base, held[1:])

    def summed(rows: np.ndarray) -> np.ndarray:
        if not rows.shape[1]:
            return rows
        first = np.flatnonzero(np.concatenate(([True], rows[1, 1:] != rows[1, :-1])))
        return np.stack((*rows[:2, first], np.add.reduceat(rows[2], first)))

    def segment(system, base: str, rows: np.ndarray) -> dict[str, object]:
        h, n = rows
        name = uuid.uuid4().hex
        arrays = {**named("keys", h.view(np.uint64) ^ _TOP), **_packed_counts(n)}
        save(arrays, system, f"{base}/{name}")
        at, cut = _next_cuts(n, most)
        return {
            "first": [int(h[0])], "second": [-1], "name": [name], "size": [len(h)],
            "total": [int(n.sum())], "ends": [int(n[h == _shifted(end)].sum())],
            **dict.fromkeys(("parents", "kinds", "sums", "whole"), [[]]),
            "at": [at], "parts": [cut], "child": [at],
        }

    rows = by_task(texts, "part int, h long, n long", counted)
    dealt = rows.repartition("part").sortWithinPartitions("h")
    level = _level(folder, by_task(dealt, _WRITTEN, convert).collect(), 1, most)
    ends = Reader(level).words(end)[1]
    return Model([level], int(ends[0]))


def _bounds(parent: int, parts: int, space: int) -> list[tuple[int, int]]:
    """Cuts of one context, by equal ranges of its children."""
    return [(parent, c) for c in sorted({-1, *(part * space // parts for part in range(1, parts))})]


def _level(folder: str, found: list, number: int, most: int) -> Level:
    """Write the directory of a level's segments, a row each."""
    found = sorted(found, key=lambda r: (r["first"], r["second"]))
    size = sum(r["size"] for r in found)
    bases = np.cumsum([0, *(r["size"] for r in found)])[:-1]
    shared: dict[int, tuple[int, int, int, int]] = {}
    for row, base in zip(found, bases.tolist()):
        for parent, kinds, sums, whole in zip(row["parents"], row["kinds"], row["sums"], row["whole"]):
            begin, k, s, _ = shared.get(parent, (base + row["size"] - kinds, 0, 0, 0))
            shared[parent] = (begin, k + kinds, s + sums, whole)
    split = sorted((p, b, k, 1 - (s - DISCOUNT * k) / max(w, 1)) for p, (b, k, s, w) in shared.items())
    # A child of an entry is a word, or a place among the successors of its last words, of
    # which those with more followers than a segment has are in several segments too.
    widest = size if number == 1 else max((kinds for _, _, kinds, _ in split), default=size)
    cuts = []
    for row, base in zip(found, bases.tolist()):
        for at, parts, child in zip(row["at"], row["parts"], row["child"]):
            space = shared[child][1] if number == 2 and child in shared else widest
            cuts += _bounds(base + at, parts, space)
    if number == 1:  # the place before a document comes after all words
        n_documents = sum(r["ends"] for r in found)
        cuts += _bounds(size, max(-(-n_documents // most), 1), size)
    arrays = {
        "parents": np.array([r["first"] for r in found], "<i8"),
        "children": np.array([r["second"] for r in found], "<i8"),
        "bases": bases.astype("<i8"),
        "sizes": np.array([r["size"] for r in found], "<i8"),
        "names": np.array([r["name"].encode() for r in found], "S32"),
        "split": np.array([p for p, *_ in split], "<i8"),
        "split_first": np.array([b for _, b, *_ in split], "<i8"),
        "split_left": _byte(np.array([left for *_, left in split], float)),
        "next_parents": np.array([p for p, _ in cuts], "<i8"),
        "next_children": np.array([c for _, c in cuts], "<i8"),
    }
    system, base = folder_of(folder)
    system.create_dir(base, recursive=True)
    save(arrays, system, f"{base}/directory")
    return Level(folder, "directory", size, sum(r["total"] for r in found))


def _add_level(
    model: Model, texts: DataFrame, least: int, chunk_tokens: int, most: int, last: bool
) -> Model:
    number = len(model.levels) + 1
    folder = scratch_dir(texts.sparkSession, f"level-{number}")
    # Contexts are the entries below and, for bigrams, the place before a document.
    n_parents = model.levels[-1].size + (number == 2)

    def ranges() -> tuple[np.ndarray, np.ndarray]:
        found = model.levels[-1].directory()
        return found["next_parents"], found["next_children"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        lookup, cuts = _Lookup(model), ranges()
        for chunk in chunks(batches, chunk_tokens):
            *_, (parents, children, _) = lookup.climb(chunk, lookup.words(chunk)[0])
            seen = (parents >= 0) & (children >= 0)
            (parent, child), _, n = _distinct(parents[seen], children[seen])
            range_ = _routes(cuts, parent, child)
            begins = np.flatnonzero(np.concatenate(([True], range_[1:] != range_[:-1])))[: len(n)]
            ends = np.append(begins[1:], len(n))
            runs = [slice(a, b) for a, b in zip(begins.tolist(), ends.tolist())]
            steps = np.diff(parent, prepend=0)
            steps[begins] = parent[begins] - cuts[0][range_[begins]]
            yield {
                "range": range_[begins],
                "size": ends - begins,
                "steps": [_narrow(steps[r]) for r in runs],
                "children": [_narrow(child[r]) for r in runs],
                "n": [_narrow(n[r]) for r in runs],
            }

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        system, base = folder_of(folder)
        system.create_dir(base, recursive=True)
        packed = segments(system, base)
        held: list[tuple] = []
        at = -1
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("range", "size", "steps", "children", "n")]
            for range_, size, *run in zip(*columns):
                if held and range_ != at:
                    yield packed(at, held)
                    held = []
                at = range_
                steps, children, n = (_wide(x, size) for x in run)
                held.append((np.cumsum(steps), children, n))
        if held:
            yield packed(at, held)

    def merged(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parent, child, n = (np.concatenate(x) for x in zip(*held))
        width = int(child.max()) + 1
        if (int(parent.max()) + 1) * width < 1 << 63:
            order = np.argsort(parent * width + child, kind="stable")  # sorted runs are merged
        else:
            order = np.lexsort((child, parent))
        parent, child = parent[order], child[order]
        new = (parent[1:] != parent[:-1]) | (child[1:] != child[:-1])
        first = np.flatnonzero(np.concatenate(([True], new)))
        n = np.add.reduceat(n[order], first)
        kept = n >= least
        return parent[first][kept], child[first][kept], n[kept]

    def segments(system, base: str) -> Callable[[int, list[tuple]], dict[str, object]]:
        below, cuts = Reader(model.levels[-1]), ranges()

        def packed(at: int, held: list[tuple]) -> dict[str, object]:
            """Write a range; its contexts are numbered from its first."""
            begun, goes_on = int(cuts[0][at]), False
            here = n_parents - begun
            if at + 1 < len(cuts[0]):
                goes_on = bool(cuts[1][at + 1] >= 0)
                here = int(cuts[0][at + 1]) + goes_on - begun
            parent, child, n = merged(held)
            whole = below.counts(begun, begun + here)
            if len(whole) < here:
                whole = np.append(whole, model.n_documents)
            kinds = np.bincount(parent, minlength=here)
            sums = np.bincount(parent, n, minlength=here).astype(np.int64)
            ends = np.cumsum(kinds)
            lasts = np.zeros(here, np.int64)
            lasts[kinds > 0] = child[ends[kinds > 0] - 1] + 1
            offset = np.repeat(np.cumsum(lasts) - lasts, kinds)
            name = uuid.uuid4().hex
            arrays = {
                **named("pointers", np.concatenate(([0], ends))),
                **named("children", child + offset),
                "values": _byte((n - DISCOUNT) / whole[parent]),
                "left": _byte(1 - (sums - DISCOUNT * kinds) / np.maximum(whole, 1)),
            }
            next_ = parts = np.zeros(0, np.int64)
            if not last:  # nothing reads the counts of the last level
                arrays |= _packed_counts(n)
                next_, parts = _next_cuts(n, most)
            save(arrays, system, f"{base}/{name}")
            shared = sorted({0} if cuts[1][at] >= 0 else {here - 1} if goes_on else set())
            return {
                "first": [begun], "second": [int(cuts[1][at])], "name": [name], "size": [len(n)],
                "total": [int(n.sum())], "ends": [0], "parents": [[begun + i for i in shared]],
                "kinds": [kinds[shared]], "sums": [sums[shared]], "whole": [whole[shared]],
                "at": [next_], "parts": [parts], "child": [child[next_]],
            }

        return packed

    runs = by_task(texts, "range long, size long, steps binary, children binary, n binary", counted)
    dealt = runs.repartition("range").sortWithinPartitions("range")
    level = _level(folder, by_task(dealt, _WRITTEN, convert).collect(), number, most)
    return model._replace(levels=[*model.levels, level])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """For every document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (tokens that
    training has), ``train_tokens``, ``base_score`` (log10, words alone) and ``score`` (log10
    probability of the text by the model).

    A null or empty text is one token, its end. Copies score alike. Without training documents all
    words have the same probability. Extra columns are not read.
    """
    n_train, n_words = model.levels[0].total, model.levels[0].size

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        lookup = _Lookup(model)
        for chunk in chunks(batches):
            number, count = lookup.words(chunk)
            words = (count + 1) / (n_train + n_words + 1)
            p = words
            for _, _, found in islice(lookup.climb(chunk, number), len(model.levels) - 1):
                own = np.where(found.number >= 0, _PROBABILITY[found.value], 0.0)
                p = own + _PROBABILITY[found.left] * p
            doc = np.repeat(np.arange(len(chunk.lengths)), chunk.lengths)
            sums = [np.bincount(doc, np.log10(x), len(chunk.lengths)) for x in (words, p)]
            yield {
                "doc_id": chunk.doc_ids,
                "held_out": chunk.held_out,
                "n_tokens": chunk.lengths,
                "n_known": np.bincount(doc, count > 0, len(chunk.lengths)).astype(np.int64),
                "train_tokens": np.full(len(chunk.lengths), n_train),
                "base_score": sums[0],
                "score": sums[1],
            }

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    return by_task(_texts(docs), schema, convert)
