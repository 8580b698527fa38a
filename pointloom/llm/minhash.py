"""Document fingerprints: one-permutation MinHash, densified, in a few bits a bin.

Every word shingle is hashed once. The high bits of its hash choose a bin, the smallest hash of
a bin is kept. An empty bin takes the value of a bin that is drawn for it over and over until
one is not empty, independently for each bin and attempt. A few bits of each value are stored,
and the chance that they agree by accident is taken out of the likeness.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import by_batch, by_task, pick, shingle_hashes, written

BINS, KEPT_BITS = 256, 4
SHINGLE, SEED = 5, 42
# Chance that two unlike bins agree in the bits that are kept.
ACCIDENT = 2.0**-KEPT_BITS
_SPREAD = np.random.default_rng(SEED).integers(0, 1 << 63, BINS, np.uint64)


@lru_cache(maxsize=4096)
def _draw(attempt: int) -> np.ndarray:
    """The bin drawn for each bin at this attempt."""
    return np.random.default_rng((SEED, attempt)).integers(0, BINS, BINS)


def fingerprint(text: str) -> bytes:
    """Kept bits of all bins, two bins a byte; nothing for a text without words."""
    hashes = np.array(shingle_hashes(text.encode().split(), SHINGLE, SEED), np.uint64)
    if not len(hashes):
        return b""
    hashes.sort()
    bins = (hashes >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(bins)) + 1))
    filled = np.zeros(BINS, bool)
    filled[bins[first]] = True
    values = np.zeros(BINS, np.uint64)
    values[bins[first]] = hashes[first]
    empty, attempt = np.flatnonzero(~filled), 0
    while len(empty):
        drawn = _draw(attempt)[empty]
        found = filled[drawn]
        values[empty[found]] = values[drawn[found]]
        empty, attempt = empty[~found], attempt + 1
    # Low-order bits, spread anew in each bin: bins that share a value must not agree by accident together.
    values = (values ^ _SPREAD) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(32)
    kept = (values & np.uint64((1 << KEPT_BITS) - 1)).astype(np.uint8)
    return (kept[0::2] << KEPT_BITS | kept[1::2]).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated share of common shingles, from 0 to 1; texts without words are like each
    other and unlike all others."""
    if not a or not b:
        return float(a == b)
    apart = np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)
    agree = np.count_nonzero(apart >> KEPT_BITS == 0) + np.count_nonzero(
        apart & ((1 << KEPT_BITS) - 1) == 0
    )
    return min(1.0, max(0.0, (agree / BINS - ACCIDENT) / (1 - ACCIDENT)))


def edited(text: str, following: str) -> str:
    """The text, its last third replaced by as much of the beginning of the following."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every document; a null text counts as empty."""

    def convert(batch: pa.RecordBatch) -> dict[str, object]:
        found = [fingerprint(t) for t in batch["text"].to_pylist()]
        return {"doc_id": batch["doc_id"], "fingerprint": found}

    texts = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
    )
    return by_batch(texts, "doc_id long, fingerprint binary", convert)


_COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)
# Rows that wait for a neighbour: the first and the last of a task.
_DONE, _HEAD, _TAIL = 0, 1, 2


def _compare(doc_id: int | None, text: str, own: bytes, following: str, next_: bytes) -> dict:
    changed = edited(text, following)
    other = fingerprint(changed)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
        "fingerprint": own,
        "edited_fingerprint": other,
        "near_edited": likeness(own, other),
        "near_next": likeness(own, next_),
    }


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Every document against its edited text and against the next one, by descending
    ``doc_id``; after the last comes the first.

    Null ids come last, null texts count as empty, and rows of one id are ordered by text hash. Rows
    alike in both follow each other, in any order, as they cannot be told apart. Extra columns are
    not read; no documents give no rows. Texts are shuffled once, by range, rows alike by
    their places in the input. A task compares neighbours as it reads them in order;
    the first and last row of each task meet those of its neighbours afterwards.
    """
    # Said outright, as few bytes may be much work: of ranges without a number small ones become one.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_hash").desc(), F.col("place")]
    ordered = (
        pick(docs, "doc_id", "text")
        .select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumns({"text_hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
        .repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
    )
    names = [*(c.split()[0] for c in _COMPARED.split(", ")), "kind", "part", "text"]

    def row(kind: int, part: int, text: str | None, values: dict) -> dict:
        return {**dict.fromkeys(names), "kind": kind, "part": part, "text": text, **values}

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        part, before = TaskContext.get().partitionId(), None
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                own = fingerprint(text)
                if before is None:
                    rows.append(row(_HEAD, part, text, {"fingerprint": own}))
                else:
                    rows.append(row(_DONE, part, None, _compare(*before, text, own)))
                before = (doc_id, text, own)
            yield {n: [r[n] for r in rows] for n in names}
        if before:
            last = row(_TAIL, part, before[1], {"doc_id": before[0], "fingerprint": before[2]})
            yield {n: [last[n]] for n in names}

    found = written(
        by_task(
            ordered.select("doc_id", "text"), f"{_COMPARED}, kind int, part int, text string", convert
        ),
        "compared",
    )
    parts = sorted(r["part"] for r in found.filter(F.col("kind") == _HEAD).select("part").collect())
    done = found.filter(F.col("kind") == _DONE).select(*names[:-3])
    if not parts:
        return done

    # Two rows per task that had any.
    pairs = list(zip(parts, [*parts[1:], parts[0]]))
    next_part = docs.sparkSession.createDataFrame(pairs, "part int, next_part int")
    tails = found.filter(F.col("kind") == _TAIL).select("part", "doc_id", "text", "fingerprint")
    heads = found.filter(F.col("kind") == _HEAD).select(
        F.col("part").alias("next_part"),
        F.col("text").alias("following"),
        F.col("fingerprint").alias("next"),
    )

    def finish(batch: pa.RecordBatch) -> dict[str, object]:
        columns = [batch[c].to_pylist() for c in ("doc_id", "text", "fingerprint", "following", "next")]
        rows = [_compare(*r) for r in zip(*columns)]
        return {n: [r[n] for r in rows] for n in names[:-3]}

    met = tails.join(next_part, "part").join(heads, "next_part")
    ends = met.select("doc_id", "text", "fingerprint", "following", "next")
    return done.unionByName(by_batch(ends, _COMPARED, finish))
