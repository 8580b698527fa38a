"""SimHash near-duplicates: fingerprints, and a binary trie joined with itself.

Fingerprints that differ in at most ``max_bits`` bits agree wholly on at least two of
``max_bits + 2`` bit blocks. So the trie is laid out once for every pair of blocks, these
blocks being its top levels, and cut there: the subtrees below the top levels are dealt to
the tasks, and each is joined with itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import by_batch, by_task, pick, shingle_hashes, utf8, written
from pointloom.llm.graph import connected
from pointloom.llm.substrings import PARTS_PER_SHUFFLE, Answers, by_part, part_of

BITS = 64
# Node pairs that are traversed together; more wait on a stack.
FRONT = 1 << 18


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """A bit is set where more than half of the shingles' XXH64 values have it set.

    Words are lower-cased in A to Z. A text of fewer words than a shingle is one shingle;
    without words the fingerprint is zero.
    """
    hashes = shingle_hashes(text.lower().split(), shingle, seed)
    if not hashes:
        return 0
    count = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = np.array(hashes[at : at + (1 << 16)], ">u8")
        count += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(hashes)).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long, for every document.

    A null text counts as empty.
    """

    def convert(batch: pa.RecordBatch) -> dict[str, object]:
        found = [signed(fingerprint(t, shingle, seed)) for t in batch["text"].to_pylist()]
        return {"doc_id": batch["doc_id"], "fp": found}

    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), utf8("text"))
    return by_batch(texts, "doc_id long, fp long", convert)


def trie_pairs(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, max_bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs, in blocks, of values that differ in 1 to ``max_bits`` bits.

    ``values`` are unsigned, and between each ``starts`` and ``ends`` sorted and distinct:
    a binary trie, whose nodes are index ranges. Node pairs go down together, bit by bit,
    with the number of bits in which their prefixes differ; a pair over the budget is
    dropped with all that is below it. Two leaves are compared at once.
    """
    zeros: dict[int, np.ndarray] = {}

    def middle(bit: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if bit not in zeros:
            clear = (values >> np.uint64(bit)) & np.uint64(1) == 0
            zeros[bit] = np.concatenate(([0], np.cumsum(clear)))
        return lo + zeros[bit][hi] - zeros[bit][lo]

    keep = ends - starts > 1
    first = (starts[keep], ends[keep], starts[keep], ends[keep], np.zeros(keep.sum(), np.int8))
    stack = [(BITS - 1, first)]
    while stack:
        bit, front = stack.pop()
        if len(front[0]) > FRONT:
            half = len(front[0]) // 2
            stack += [(bit, tuple(x[:half] for x in front)), (bit, tuple(x[half:] for x in front))]
            continue
        a0, a2, b0, b2, bits = front
        leaves = (a2 - a0 == 1) & (b2 - b0 == 1)
        if leaves.any():
            i, j = a0[leaves], b0[leaves]
            near = np.bitwise_count(values[i] ^ values[j]) <= max_bits
            if near.any():
                yield i[near], j[near]
            a0, a2, b0, b2, bits = (x[~leaves] for x in front)
        if not len(a0):
            continue
        a1, b1 = middle(bit, a0, a2), middle(bit, b0, b2)
        twins = a0 == b0
        down = []
        for lo, hi, lo2, hi2, more in (
            (a0, a1, b0, b1, 0),
            (a1, a2, b1, b2, 0),
            (a0, a1, b1, b2, 1),
            (a1, a2, b0, b1, 1),
        ):
            alive = (hi > lo) & (hi2 > lo2) & (bits + more <= max_bits)
            if more:
                alive &= ~twins | (lo < lo2)  # a node's children meet once
            else:
                alive &= ~twins | (hi - lo > 1)
            down.append([x[alive] for x in (lo, hi, lo2, hi2, bits + np.int8(more))])
        stack.append((bit - 1, tuple(np.concatenate(x) for x in zip(*down, strict=True))))


def union(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the classes of each pair; a class is labelled by its smallest index."""
    while True:
        low, high = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
        apart = low < high
        if not apart.any():
            return labels
        a, b = a[apart], b[apart]
        np.minimum.at(labels, high[apart], low[apart])
        while not np.array_equal(labels, nearer := labels[labels]):
            labels = nearer


def links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """(``a``, ``b``): enough links between the distinct longs of ``fp`` to connect those
    that differ in at most ``max_bits`` bits, directly or over others.

    A subtree gives a spanning forest of its links, one row per fingerprint at most, so
    many near copies never give all their pairs. A task holds one subtree at a time: the
    distinct fingerprints that share two whole blocks, copies of one text being one.
    """
    blocks = max_bits + 2
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    routes = [signed(x | y) for x, y in combinations(masks, 2)]
    subtree = F.array(
        *[
            F.struct(F.lit(i).alias("route"), F.col("fp").bitwiseAND(F.lit(m)).alias("top"))
            for i, m in enumerate(routes)
        ]
    )
    dealt = (
        prints.select("fp", F.inline(subtree))
        .repartition("route", "top")
        .sortWithinPartitions("route", "top", "fp")
    )

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        held: list[np.ndarray] = [np.zeros((3, 0), np.int64)]
        for batch in batches:
            rows = np.stack([batch[c].to_numpy().astype(np.int64) for c in ("route", "top", "fp")])
            new = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(0)) + 1
            if held[-1].size and not (held[-1][:2, -1] == rows[:2, 0]).all():
                new = np.concatenate(([0], new))
            if len(new):  # all but the last subtree, which may go on, is complete
                yield joined(np.concatenate([*held, rows[:, : new[-1]]], axis=1))
                held = [rows[:, new[-1] :]]
            else:
                held.append(rows)
        yield joined(np.concatenate(held, axis=1))

    def joined(rows: np.ndarray) -> dict[str, object]:
        if not rows.shape[1]:
            return {"a": [], "b": []}
        starts = np.concatenate(([0], np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(0)) + 1))
        ends = np.append(starts[1:], rows.shape[1])
        # Signed order is the order of the unsigned values with the top bit turned over.
        values = rows[2].view(np.uint64) ^ np.uint64(1 << (BITS - 1))
        labels = np.arange(len(values))
        for a, b in trie_pairs(values, starts, ends, max_bits):
            labels = union(labels, a, b)
        moved = np.flatnonzero(labels != np.arange(len(values)))
        return {"a": rows[2][moved], "b": rows[2][labels[moved]]}

    return by_task(dealt.select("route", "top", "fp"), "a long, b long", convert)


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42
) -> DataFrame:
    """``doc_id``, ``fp``, ``root`` and ``component_id`` for every document: the smallest
    fingerprint and ``doc_id`` reachable over fingerprints that differ in at most ``max_bits``
    bits.

    Reads ``doc_id`` and ``text``, whatever other columns there are. Null and empty texts have
    the fingerprint zero and are linked like any other. Rows alike give rows alike. A null
    ``doc_id`` is never the smallest unless all of its component are null, which gives null. No
    documents give no rows. Copies meet as one fingerprint before anything is compared.
    """
    prints = written(fingerprints(docs, shingle, seed), "fingerprints")
    components = _components(prints, max_bits)
    return prints.join(components, "fp").select("doc_id", "fp", "root", "component_id")


def _components(prints: DataFrame, max_bits: int) -> DataFrame:
    """``fp``, ``root`` and ``component_id`` of every fingerprint in a table."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected(links(distinct.select("fp"), max_bits)).toDF("fp", "root")
    classes = distinct.join(roots, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return classes.join(least, "root").select("fp", "root", "component_id")


def hex_digits(name: str):
    """A signed long as 16 lower-case digits."""
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def keep_one_of_each(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42
) -> DataFrame:
    """The rows of ``docs``, one of each component of :func:`near_duplicates`, all columns.

    It is the one with the smallest ``doc_id`` (null last); among equal ids that with the
    smallest fingerprint, then the smallest hash of the text, then the first of its file. Each
    fingerprint is made once. What goes is told by file and row in the shared folder, where the
    tasks that read the documents look it up, so texts are not moved. No documents give no rows.
    """
    names = [f"__column_{i}" for i in range(len(docs.columns))]
    id_at, text_at = docs.columns.index("doc_id"), docs.columns.index("text")
    rows = _with_rows(docs, names)
    parts = PARTS_PER_SHUFFLE * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def convert(batch: pa.RecordBatch) -> dict[str, object]:
        texts = batch["text"].to_pylist()
        return {
            "file": batch["file"],
            "row": batch["row"],
            "doc_id": batch["doc_id"],
            "fp": [signed(fingerprint(t, shingle, seed)) for t in texts],
            "text_hash": [signed(xxhash.xxh64_intdigest(t, seed)) for t in texts],
        }

    texts = rows.select(
        "file", "row", F.col(names[id_at]).cast("long").alias("doc_id"),
        utf8(names[text_at]).alias("text"),
    )
    schema = "file long, row long, doc_id long, fp long, text_hash long"
    prints = written(by_batch(texts, schema, convert), "fingerprints")
    placed = prints.join(_components(prints, max_bits).select("fp", "root"), "fp")
    # The numbers of a row in an order in which null ids come last.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "text_hash", "file", "row")
    first = placed.groupBy("root").agg(F.min(order).alias("first"))
    kept = first.select("root", F.col("first.file").alias("kept_file"), F.col("first.row").alias("kept_row"))
    gone = placed.join(kept, "root").filter("file != kept_file OR row != kept_row")
    gone = gone.select("file", "row", F.lit(0).alias("start"), F.lit(1).alias("span"))
    told = by_part(gone, parts, "near-duplicates")

    @F.pandas_udf("boolean")
    def stays(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        answers = Answers(told)
        for places in batches:
            yield pd.Series([not len(answers.of(*place)[0]) for place in zip(*places)], dtype=bool)

    return rows.filter(stays("file", "row", part_of(parts))).select(*names).toDF(*docs.columns)


def _with_rows(docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns under other names, and ``file`` (a hash of its path) and ``row`` of each row.
    What is no plain scan of Parquet files is written first."""
    place = ("_metadata.file_path", "_metadata.row_index")
    try:
        marked = docs.select("*", *place)
    except AnalysisException:
        marked = written(docs.toDF(*names), "documents").select("*", *place)
    return marked.toDF(*names, "file", "row").withColumns(
        {"file": F.xxhash64("file"), "row": F.col("row").cast("long")}
    )
