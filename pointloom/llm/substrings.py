"""Removing word passages that repeat, found by difference-cover anchors.

A passage repeats if its windows of ``WINDOW`` words do. Instead of all windows, short anchors
are hashed first, and only where their position modulo ``PERIOD`` is in a difference cover:
whatever the positions of two equal windows are, they have one anchor in the same place. Only
around anchors that occur twice are windows hashed and counted, which extends the anchors
and makes the result exact.

Hashes are shuffled, texts are not: tasks read the documents again and find what was told about
their rows in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import by_task, folder_of, pick, scratch_dir, utf8, written

WINDOW = 35
# Every difference modulo the period is one of two of these.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
# Words that a task looks at together; repeats among them are told without a shuffle.
CHUNK_WORDS = 1 << 20
# Rows of answers that are sorted together.
ANSWERS = 1 << 19
# Answers about 2 ** BLOCK_BITS rows of a file are in one part; parts for each shuffle partition.
BLOCK_BITS, PARTS_PER_SHUFFLE = 12, 4

SEED = 42
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CHECK_BASE = np.uint64(0xC2B2AE3D27D4EB4F)

# A message: hash, row of a file, and start of the hashed words, a number and a kind packed.
MESSAGE = "h long, file long, row long, at long"
_ASK, _TELL, _KNOWN = 0, 1, 2
_NUMBER = (1 << 30) - 1


def rolling(values: np.ndarray, size: int, base: np.uint64 = _BASE) -> np.ndarray:
    """Hash of every run of ``size`` values, put together from runs of powers of two."""
    whole, covered, run, length = None, 0, values, 1
    while True:
        if size & length:
            if whole is None:
                whole = run
            else:
                n = len(values) - covered - length + 1
                whole = whole[: max(n, 0)] * base ** np.uint64(length) + run[covered:]
            covered += length
        if covered == size:
            return whole
        run = run[: max(len(run) - length, 0)] * base ** np.uint64(length) + run[length:]
        length *= 2


class Chunk(NamedTuple):
    """Documents end to end: word hashes, and for each document where it begins, its length,
    its file, its row there, and the part that answers about it are in."""

    words: np.ndarray
    begins: np.ndarray
    lengths: np.ndarray
    files: np.ndarray
    rows: np.ndarray
    parts: np.ndarray


def chunks(batches: Iterator[pa.RecordBatch], wanted=None) -> Iterator[Chunk]:
    """Chunks of the documents of at least one window; ``wanted`` may leave some out."""
    numbers: dict[bytes, int] = {}
    tokens: list[np.ndarray] = []
    places: list[tuple[int, int, int]] = []
    size = 0

    def chunk() -> Chunk:
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(w, SEED) for w in numbers), np.uint64, len(numbers)
        )
        lengths = np.array([len(t) for t in tokens], np.int64)
        begins = np.cumsum(lengths) - lengths
        return Chunk(hashes[np.concatenate(tokens)], begins, lengths, *np.array(places, np.int64).T)

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("file", "row", "part", "text")]
        for *place, text in zip(*columns):
            if wanted and not wanted(*place):
                continue
            words = text.split()
            if len(words) < WINDOW:
                continue
            found = np.fromiter(
                (numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words)
            )
            tokens.append(found)
            places.append(place)
            size += len(words)
            if size >= CHUNK_WORDS:
                yield chunk()
                numbers, tokens, places, size = {}, [], [], 0
    if tokens:
        yield chunk()


def _messages(
    chunk: Chunk, h: np.ndarray, check: np.ndarray, doc: np.ndarray, start: np.ndarray
) -> dict[str, np.ndarray]:
    """What a task has to tell about hashes, combined: a hash is sent once.

    One that occurs once in the chunk asks whether others have it. Of one that occurs more
    often, one message tells so, and the answers are known: they go along as runs of starts.
    """
    order = np.lexsort((check, h))
    same = (h[order[1:]] == h[order[:-1]]) & (check[order[1:]] == check[order[:-1]])
    first = np.concatenate(([True], ~same))[: len(order)]
    more = np.concatenate((same, [False]))[: len(order)]
    once = order[first & ~more]
    told = order[first & more]
    known = np.sort(order[~first | more])  # by document and start, as they were found
    joined = (np.diff(start[known]) == 1) & (np.diff(doc[known]) == 0)
    run = np.flatnonzero(np.concatenate(([True], ~joined)))[: len(known)]
    spans = np.diff(np.append(run, len(known)))
    known = known[run]
    rows = np.concatenate((once, told, known))
    number = np.concatenate((check[once], check[told], spans)).astype(np.int64)
    kind = np.repeat([_ASK, _TELL, _KNOWN], [len(once), len(told), len(known)])
    sent = h[rows].copy()
    # Known answers need no meeting; spread them.
    sent[len(once) + len(told) :] += (doc[known].astype(np.uint64) + np.uint64(1)) * _BASE
    return {
        "h": sent.view(np.int64),
        "file": chunk.files[doc[rows]],
        "row": chunk.rows[doc[rows]],
        "at": start[rows] << 32 | number << 2 | kind,
    }


def _answered(messages: DataFrame) -> DataFrame:
    """(``file``, ``row``, ``start``, ``span``) of hashes that were sent from two places.

    A hash comes at most once from each chunk, so no hash has many rows here.
    """
    dealt = messages.repartition("h").sortWithinPartitions("h")

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        held = np.zeros((4, 0), np.int64)
        answers: list[np.ndarray] = []
        size = 0
        for batch in batches:
            rows = np.stack([batch[c].to_numpy() for c in ("h", "file", "row", "at")])
            rows = np.concatenate((held, rows), axis=1)
            last = np.searchsorted(rows[0], rows[0, -1]) if rows.shape[1] else 0
            answers.append(met(rows[:, :last]))
            held = rows[:, last:]
            size += answers[-1].shape[1]
            if size >= ANSWERS:
                yield in_order(answers)
                answers, size = [], 0
        yield in_order([*answers, met(held)])

    def met(rows: np.ndarray) -> np.ndarray:
        h, file, row, at = rows
        kind, number, start = at & 3, at >> 2 & _NUMBER, at >> 32
        known = kind == _KNOWN
        ask = np.flatnonzero(~known)
        ask = ask[np.lexsort((number[ask], h[ask]))]
        same = (h[ask[1:]] == h[ask[:-1]]) & (number[ask[1:]] == number[ask[:-1]])
        others = np.zeros(len(ask), bool)
        others[1:] |= same
        others[:-1] |= same
        found = ask[others & (kind[ask] == _ASK)]
        known = np.flatnonzero(known)
        rows = np.concatenate((found, known))
        span = np.concatenate((np.ones(len(found), np.int64), number[known]))
        return np.stack((file[rows], row[rows], start[rows], span))

    def in_order(answers: list[np.ndarray]) -> dict[str, object]:
        rows = np.concatenate(answers, axis=1)
        rows = rows[:, np.lexsort(rows[2::-1])]
        return dict(zip(("file", "row", "start", "span"), (*rows[:2], *rows[2:].astype(np.int32))))

    return by_task(dealt, "file long, row long, start int, span int", convert)


def part_of(parts: int) -> Column:
    """Where answers about a document are: neighbours in a file share a part."""
    block = F.shiftright("row", BLOCK_BITS)
    return F.pmod(F.xxhash64("file", block), F.lit(parts)).cast("int").alias("part")


def by_part(answers: DataFrame, parts: int, purpose: str) -> str:
    """Write answers where the tasks that read the documents find them."""
    path = scratch_dir(answers.sparkSession, purpose)
    dealt = answers.withColumn("part", part_of(parts)).repartition("part")
    ordered = dealt.sortWithinPartitions("part", "file", "row", "start")
    ordered.write.partitionBy("part").parquet(path)
    return path


class Answers:
    """Answers of the part that a task is at."""

    def __init__(self, path: str) -> None:
        self.system, self.base = folder_of(path)
        self.part: int | None = None

    def _open(self, part: int) -> None:
        folder = fs.FileSelector(f"{self.base}/part={part}", allow_not_found=True)
        tables = []
        for info in self.system.get_file_info(folder):
            if info.path.endswith(".parquet"):
                with self.system.open_input_file(info.path) as opened:
                    tables.append(pq.ParquetFile(opened).read())
        columns = [
            np.concatenate([t[c].to_numpy().astype(np.int64) for t in tables] or [np.zeros(0, np.int64)])
            for c in ("file", "row", "start", "span")
        ]
        order = np.lexsort(columns[1::-1])
        self.files, self.rows, self.starts, self.spans = (c[order] for c in columns)
        self.part = part

    def of(self, file: int, row: int, part: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and spans told about a row."""
        if part != self.part:
            self._open(part)
        low, high = np.searchsorted(self.files, file), np.searchsorted(self.files, file, "right")
        a, b = low + np.searchsorted(self.rows[low:high], (row, row + 1))
        return self.starts[a:b], self.spans[a:b]


def _covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the ranges."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, ends, -1)
    return np.cumsum(edges[:-1]) > 0


_ORDINAL = np.full(PERIOD, -1)
_ORDINAL[list(COVER)] = np.arange(len(COVER))
ANCHOR = WINDOW - PERIOD + 1


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
    """Messages about anchors, numbered along a document."""
    for chunk in chunks(batches):
        doc = np.repeat(np.arange(len(chunk.lengths)), chunk.lengths)
        place = np.arange(len(chunk.words)) - chunk.begins[doc]
        fits = (_ORDINAL[place % PERIOD] >= 0) & (place + ANCHOR <= chunk.lengths[doc])
        at = np.flatnonzero(fits)
        doc, place = doc[at], place[at]
        number = place // PERIOD * len(COVER) + _ORDINAL[place % PERIOD]
        h = rolling(chunk.words, ANCHOR)[at]
        yield _messages(chunk, h, np.zeros(len(h), np.int64), doc, number)


def _candidates(starts: np.ndarray, spans: np.ndarray, size: int) -> np.ndarray:
    """Starts of all windows that hold one of the anchors."""
    number = np.repeat(starts - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
    place = number // len(COVER) * PERIOD + np.array(COVER)[number % len(COVER)]
    last = size - WINDOW
    low, high = np.maximum(place - PERIOD + 1, 0), np.minimum(place, last) + 1
    good = low < high
    return np.flatnonzero(_covered(low[good], high[good], last + 1))


def located(docs: DataFrame, parts: int) -> DataFrame:
    """``doc_id``, ``file``, ``row``, ``part``, ``text`` of every document: a file is told by the
    hash of its path. What is no plain scan of Parquet files is written first."""
    names = ("doc_id", "text")
    try:
        marked = docs.select(
            "_metadata.file_path", "_metadata.row_index", *[docs[n].alias(n) for n in names]
        )
    except AnalysisException:
        marked = written(pick(docs, *names), "documents").select(
            "_metadata.file_path", "_metadata.row_index", *names
        )
    return marked.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("file_path").alias("file"),
        F.col("row_index").cast("long").alias("row"),
        utf8("text"),
    ).select("doc_id", "file", "row", part_of(parts), "text")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``text`` of every document: the words left,
    joined by one space, when those that lie in a repeated window are gone.

    A window repeats if its words start anywhere else too, in the same document or over itself
    included. All are judged on the input. Null and empty texts have no words. Rows alike lose
    all that is in a window. Extra columns are not read; no documents give no rows. Windows are
    told apart by 94 bits of hash.
    """
    parts = PARTS_PER_SHUFFLE * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = located(docs, parts)
    by_row = texts.select("file", "row", "part", "text")
    anchors = by_part(_answered(by_task(by_row, MESSAGE, _anchors)), parts, "anchors")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        told = Answers(anchors)
        for chunk in chunks(batches, lambda *place: len(told.of(*place)[0])):
            starts, docs = [], []
            places = zip(*(x.tolist() for x in (chunk.files, chunk.rows, chunk.parts, chunk.lengths)))
            for d, (*place, size) in enumerate(places):
                found = _candidates(*told.of(*place), size)
                starts.append(found)
                docs.append(np.full(len(found), d))
            start, doc = np.concatenate(starts), np.concatenate(docs)
            at = chunk.begins[doc] + start
            h = rolling(chunk.words, WINDOW)[at]
            check = rolling(chunk.words ^ (chunk.words >> np.uint64(29)), WINDOW, _CHECK_BASE)[at]
            yield _messages(chunk, h, (check >> np.uint64(34)).astype(np.int64), doc, start)

    repeats = by_part(_answered(by_task(by_row, MESSAGE, windows)), parts, "windows")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        told = Answers(repeats)
        for batch in batches:
            n_words, n_removed, left = [], [], []
            columns = [batch[c].to_pylist() for c in ("file", "row", "part", "text")]
            for *place, text in zip(*columns):
                words = text.split()
                starts, spans = told.of(*place)
                n_words.append(len(words))
                if len(starts):
                    gone = _covered(starts, starts + spans + WINDOW - 1, len(words))
                    words = [words[i] for i in np.flatnonzero(~gone).tolist()]
                n_removed.append(n_words[-1] - len(words))
                left.append(b" ".join(words).decode())
            yield {
                "doc_id": batch["doc_id"], "n_words": n_words, "n_removed": n_removed, "text": left
            }

    return by_task(texts, "doc_id long, n_words long, n_removed long, text string", kept)
