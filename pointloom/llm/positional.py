"""Benchmark decontamination on a positional inverted index of the training documents.

The index is a table of segments: some thousand documents each, with every term's positions.
Test items are looked up segment by segment: the lists of a window's terms are moved by
their offsets and intersected, beginning with the rarest term of that segment. Postings
are never shuffled, and a frequent word only lengthens lists within segments.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import by_task, folder_of, pick, scratch_dir, utf8, written

# Tokens after which a segment is closed.
SEGMENT_TOKENS = 1 << 19
# Test items that a task holds at a time.
ITEMS_PER_BLOCK = 5_000

SEGMENT = (
    "doc_ids array<bigint>, lengths array<int>, terms binary, counts binary, postings binary"
)

# Fixed value: words are runs of other code points than these ASCII ones, lower-cased in
# A to Z. As bytes of UTF-8: letters and digits stay, all other ASCII parts words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def build_index(docs: DataFrame) -> DataFrame:
    """Segments over all documents, written to the shared folder.

    Positions count on through a segment, one being left free after each document, so no
    phrase runs from one into the next. They are kept as steps, byte planes apart, which
    Parquet's codec makes small. A null text has no words.
    """
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), utf8("text"))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        ids: list[int | None] = []
        lengths: list[int] = []
        numbers: dict[bytes, int] = {}
        tokens: list[int] = []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                words = words_of(text)
                ids.append(doc_id)
                lengths.append(len(words))
                tokens += [numbers.setdefault(w, len(numbers)) for w in words]
                if len(tokens) >= SEGMENT_TOKENS:
                    yield _segment(ids, lengths, numbers, tokens)
                    ids, lengths, numbers, tokens = [], [], {}, []
        if ids:
            yield _segment(ids, lengths, numbers, tokens)

    path = scratch_dir(docs.sparkSession, "positional-index")
    segments = by_task(texts, SEGMENT, convert)
    segments.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(SEGMENT).parquet(path)


def _segment(
    ids: list[int | None], lengths: list[int], numbers: dict[bytes, int], tokens: list[int]
) -> dict[str, object]:
    terms = list(numbers)
    order = sorted(range(len(terms)), key=terms.__getitem__)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    term = rank[np.array(tokens, np.int64)]
    place = np.arange(len(tokens)) + np.repeat(np.arange(len(lengths)), lengths)
    by_term = np.argsort(term, kind="stable")
    places = place[by_term]
    counts = np.bincount(term, minlength=len(order)).astype("<u4")
    steps = np.diff(places, prepend=0)
    firsts = np.cumsum(counts)[:-1]
    steps[firsts] = places[firsts]  # a term's list begins anew
    planes = steps.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return {
        "doc_ids": [ids],
        "lengths": [lengths],
        "terms": [b" ".join(terms[i] for i in order)],
        "counts": [counts.tobytes()],
        "postings": [planes.tobytes()],
    }


class Segment(NamedTuple):
    """A segment unpacked: ``places[begins[t]:begins[t + 1]]`` are those of term ``t``."""

    doc_ids: list[int | None]
    lengths: np.ndarray
    bases: np.ndarray
    numbers: dict[bytes, int]
    begins: np.ndarray
    places: np.ndarray

    def of(self, term: int) -> np.ndarray:
        return self.places[self.begins[term] : self.begins[term + 1]]


def unpack(row: dict[str, object]) -> Segment:
    lengths = np.array(row["lengths"], np.int64)
    counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
    planes = np.frombuffer(row["postings"], np.uint8).reshape(4, -1)
    steps = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
    begins = np.concatenate(([0], np.cumsum(counts)))
    sums = np.cumsum(steps)
    before = np.repeat(np.concatenate(([0], sums))[begins[:-1]], counts)
    bases = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    numbers = {t: i for i, t in enumerate(row["terms"].split())}
    return Segment(row["doc_ids"], lengths, bases, numbers, begins, sums - before)


class Windows(NamedTuple):
    """Distinct windows of test items: rows of numbers into ``terms``, by length."""

    terms: list[bytes]
    groups: list[tuple[np.ndarray, list[list[int]]]]
    item_ids: list[int | None]


def windows_of(items: list[tuple[int | None, bytes]], size: int) -> Windows:
    """All runs of ``size`` words of the items; a shorter item is one window, one without
    words none."""
    numbers: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[int]] = {}
    ids = [item_id for item_id, _ in items]
    for i, (_, text) in enumerate(items):
        words = [numbers.setdefault(w, len(numbers)) for w in words_of(text)]
        for at in range(max(len(words) - size, 0) + 1 if words else 0):
            owners.setdefault(tuple(words[at : at + size]), set()).add(i)
    lengths = sorted({len(w) for w in owners})
    groups = []
    for length in lengths:
        some = [w for w in owners if len(w) == length]
        groups.append((np.array(some, np.int64), [sorted(owners[w]) for w in some]))
    return Windows(list(numbers), groups, ids)


def _counts(segment: Segment, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Number in the segment and count of each test term; 0 for those it does not have."""
    numbers = np.array([segment.numbers.get(t, -1) for t in windows.terms], np.int64)
    count = np.append(np.diff(segment.begins), 0)[numbers]
    return numbers, count


def phrases(segment: Segment, windows: Windows) -> Iterator[tuple[np.ndarray, int, list[int]]]:
    """Places where windows begin, with their length and the items that have them."""
    if not windows.terms:
        return
    numbers, count = _counts(segment, windows)
    for rows, owners in windows.groups:
        for w in np.flatnonzero((count[rows] > 0).all(1)):
            row = rows[w]
            order = np.argsort(count[row], kind="stable")
            begins = segment.of(numbers[row[order[0]]]) - order[0]
            for offset in order[1:]:
                begins = _present(segment.of(numbers[row[offset]]), begins + offset) - offset
                if not len(begins):
                    break
            else:
                yield begins, len(row), owners[w]


def _present(places: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(places, wanted)
    at[at == len(places)] = 0
    return wanted[places[at] == wanted]


def near(
    segment: Segment, windows: Windows, slop: int
) -> Iterator[tuple[np.ndarray, int, list[int]]]:
    """Places where all terms of a window, in any order, lie within its length plus
    ``slop`` words of one document, with that length."""
    if not windows.terms:
        return
    numbers, count = _counts(segment, windows)
    for rows, owners in windows.groups:
        span = rows.shape[1] + slop
        for w in np.flatnonzero((count[rows] > 0).all(1)):
            terms = np.unique(rows[w])
            lists = [segment.of(numbers[t]) for t in terms[np.argsort(count[terms])]]
            # A match begins at one of the terms, and has the rarest one within its span.
            begins = np.unique(np.concatenate(lists))
            document = np.searchsorted(segment.bases, begins, "right") - 1
            ends = np.minimum(begins + span, segment.bases[document] + segment.lengths[document])
            for places in lists:
                at = np.searchsorted(places, begins)
                inside = at < len(places)
                inside[inside] = places[at[inside]] < ends[inside]
                begins, ends = begins[inside], ends[inside]
                if not len(begins):
                    break
            else:
                yield begins, span, owners[w]


def _blocks(path: str, size: int) -> Iterator[Windows]:
    """The test items in blocks of bounded size, read in a task."""
    system, folder = folder_of(path)
    files = system.get_file_info(fs.FileSelector(folder))
    for name in sorted(f.path for f in files if f.path.endswith(".parquet")):
        with system.open_input_file(name) as file:
            for batch in pq.ParquetFile(file).iter_batches(ITEMS_PER_BLOCK):
                items = zip(batch["item_id"].to_pylist(), batch["text"].to_pylist())
                yield windows_of(list(items), size)


def _matched(index: DataFrame, benchmark: DataFrame, size: int, schema: str, convert) -> DataFrame:
    items = pick(benchmark, "item_id", "text").select(F.col("item_id").cast("string"), utf8("text"))
    path = scratch_dir(index.sparkSession, "test-items")
    items.write.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        held = list(islice(_blocks(path, size), 2))
        for batch in batches:
            for row in batch.to_pylist():
                # A benchmark of one block is read once per task, others per segment.
                yield convert(unpack(row), iter(held) if len(held) < 2 else _blocks(path, size))

    return by_task(index, schema, run)


def contaminated(index: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """For every document: ``doc_id``, ``n_words``, ``n_hit`` (words inside an occurrence of
    a window of ``size`` item words), ``item_ids`` (items with occurring windows, distinct, in
    string order; a null id is left out there but counted) and ``n_items``.

    ``benchmark`` may be of any size: tasks read it in blocks from the shared folder.
    Documents and items with a null or empty text have no words and match nothing. Rows
    alike, in either table, change nothing but the number of rows returned.
    """

    def convert(segment: Segment, blocks: Iterator[Windows]) -> dict[str, object]:
        size_of = int(segment.bases[-1] + segment.lengths[-1]) if len(segment.lengths) else 0
        edges = np.zeros(size_of + 2, np.int64)
        items: list[set[str | None]] = [set() for _ in segment.doc_ids]
        for windows in blocks:
            for begins, length, owners in phrases(segment, windows):
                np.add.at(edges, begins, 1)
                np.add.at(edges, begins + length, -1)
                found = {windows.item_ids[i] for i in owners}
                for d in set((np.searchsorted(segment.bases, begins, "right") - 1).tolist()):
                    items[d] |= found
        hit = np.concatenate(([0], np.cumsum(np.cumsum(edges) > 0)))
        ends = segment.bases + segment.lengths
        return {
            "doc_id": segment.doc_ids,
            "n_words": segment.lengths,
            "n_hit": hit[ends] - hit[segment.bases],
            "n_items": [len(i) for i in items],
            "item_ids": [sorted(x for x in i if x is not None) for i in items],
        }

    schema = "doc_id long, n_words long, n_hit long, n_items long, item_ids array<string>"
    return _matched(index, benchmark, size, schema, convert)


def proximity(index: DataFrame, benchmark: DataFrame, size: int = 10, slop: int = 5) -> DataFrame:
    """(``doc_id``, ``item_id``, ``begin``, ``span``): every place of a document from which
    on all words of a window of the item come, in any order, within ``span`` words."""

    def convert(segment: Segment, blocks: Iterator[Windows]) -> dict[str, object]:
        found = []
        for windows in blocks:
            for begins, span, owners in near(segment, windows, slop):
                documents = np.searchsorted(segment.bases, begins, "right") - 1
                for d, at in zip(documents.tolist(), (begins - segment.bases[documents]).tolist()):
                    found += [(segment.doc_ids[d], windows.item_ids[i], at, span) for i in owners]
        rows = sorted(set(found), key=repr)
        names = ("doc_id", "item_id", "begin", "span")
        return {name: [r[i] for r in rows] for i, name in enumerate(names)}

    return _matched(index, benchmark, size, "doc_id long, item_id string, begin long, span int", convert)



def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no window of an item occurs.

    Documents are told apart by id and text hash, so rows that share an id are judged
    singly; rows with a match are few or many, and are taken out by an anti join.
    """
    names = [f"__column_{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = names[docs.columns.index("text")]
    key = F.xxhash64(F.col(names[docs.columns.index("doc_id")]).cast("string"), F.col(text))
    marked = plain.withColumn("__key", key)
    keyed = marked.select(F.col("__key").alias("doc_id"), F.col(text).alias("text"))
    hits = written(contaminated(build_index(keyed), benchmark, size).filter("n_hit > 0"), "hits")
    bad = hits.select(F.col("doc_id").alias("__key")).distinct()
    return marked.join(bad, "__key", "left_anti").select(*names).toDF(*docs.columns)
