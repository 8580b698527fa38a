"""Toxicity from confirmed toxic examples and unlabelled text alone.

A linear model over the distinct words of a text, trained with the non-negative
positive-unlabelled risk: what the unlabelled text costs as non-toxic, less the share of it
that the class prior says is toxic, and never less than nothing. It is fitted on all documents
of the fold: what they come to is counted in tasks, and each step sums over all of them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import by_batch, by_task, pick, utf8, written

# Documents whose words are counted together, and distinct sets of weights of documents, each with
# its number of documents, up to which the driver sums; more are summed by tasks, to the same.
ROWS, SETS = 1 << 8, 1 << 15
# Sums are of whole numbers of this fraction and of its square, so the same in whatever order.
_UNIT = float(1 << 26)
# Weights of the model: a word counts by itself and by its beginnings.
BUCKETS = 1 << 18
BEGINNINGS = (4, 6)
STEPS, RATE, DECAY = 150, 0.05, 5e-4
# A bucket gets a weight if so many toxic examples have it, so much more often than usual.
LEAST_EXAMPLES, CLEARLY = 3, 5.0
# Words whose weights a task remembers.
MEMO = 1 << 20

_LETTERS = re.compile(rb"[a-z\x80-\xff]+")


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def words_of(text: bytes) -> set[bytes]:
    return set(_LETTERS.findall(text.lower()))


def buckets_of(word: bytes) -> list[int]:
    """The weights a word counts by: its own and those of its beginnings."""
    parts = [b"=" + word, *(word[:n] for n in BEGINNINGS if len(word) >= n)]
    return [xxhash.xxh64_intdigest(p) % BUCKETS for p in parts]


def training_fold(doc_id: str = "doc_id", folds: int = 4, held_out: int = 2) -> Column:
    """Rows that labels may be learned from. A null id is held out."""
    fold = F.crc32(F.col(doc_id).cast("string")) % folds
    return F.coalesce(fold != held_out, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Model | None:
    """A model of ``labels.toxic`` from the training fold; None without a toxic example.

    The class prior is counted over all labelled rows of the fold. The toxic examples are all
    documents of the fold with label 1, the unlabelled ones all of the fold with whatever label or
    none, which is not looked at. A ``doc_id`` of several rows counts as one document, with one of
    its texts. Only counts of hashed words, and sums, reach the driver.
    """
    known = (
        pick(labels, "doc_id", "toxic")
        .filter(training_fold() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return None
    # Written, so that few ids are known to be few and no text is moved.
    toxic = written(known.filter("toxic = 1").select("doc_id"), "toxic-ids")
    texts = pick(docs, "doc_id", "text").filter(training_fold()).select("doc_id", utf8("text"))
    repeated = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    repeated = written(repeated, "ids-of-several-rows")
    # Of the texts of one id the one with the smallest hash.
    first = F.min(F.struct(F.xxhash64("text", F.lit(seed)), "text"))["text"].alias("text")
    several = texts.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(first)
    unlabelled = texts.join(repeated, "doc_id", "left_anti").union(several)
    positive = unlabelled.join(toxic, "doc_id", "left_semi")
    if positive.isEmpty():
        return None
    return train(Examples(positive), Examples(unlabelled), min(prior, 0.99))


def _remembering(of: Callable[[bytes], tuple[int, ...]]) -> Callable[[bytes], tuple[int, ...]]:
    """The same function, which remembers ``MEMO`` words."""
    known: dict[bytes, tuple[int, ...]] = {}

    def remembered(word: bytes) -> tuple[int, ...]:
        found = known.get(word)
        if found is None:
            if len(known) >= MEMO:
                known.clear()
            found = known[word] = of(word)
        return found

    return remembered


class Examples:
    """Documents (``text``), each as the buckets of its words."""

    def __init__(self, texts: DataFrame) -> None:
        self.texts = texts.select("text")

    def __iter__(self) -> Iterator[np.ndarray]:
        def convert(batch: pa.RecordBatch) -> dict[str, object]:
            found = [sorted({b for w in words_of(t) for b in buckets_of(w)}) for t in batch["text"].to_pylist()]
            return {"buckets": [np.array(f, "<i4").tobytes() for f in found]}

        for row in by_batch(self.texts, "buckets binary", convert).orderBy("buckets").toLocalIterator():
            yield np.frombuffer(row["buckets"], "<i4")

    def counts(self) -> tuple[int, np.ndarray]:
        """Documents, and those that have each bucket."""

        def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
            buckets, have, n = _remembering(lambda w: tuple(buckets_of(w))), np.zeros(BUCKETS, np.int64), 0
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    texts = batch["text"].slice(at, ROWS).to_pylist()
                    some = [b for t in texts for b in set().union(*map(buckets, words_of(t)))]
                    have += np.bincount(np.array(some, np.int64), minlength=BUCKETS)
                    n += len(texts)
            found = np.flatnonzero(have)
            yield {"bucket": np.append(found, BUCKETS), "n": np.append(have[found], n)}

        rows = by_task(self.texts, "bucket long, n long", convert).groupBy("bucket").agg(F.sum("n"))
        have = np.zeros(BUCKETS + 1, np.int64)
        for bucket, n in rows.collect():
            have[bucket] = n
        return int(have[-1]), have[:-1]

    def within(self, columns: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        """The function :func:`_sums` of a model over all documents."""

        def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
            places = {int(c): i for i, c in enumerate(columns)}
            weighted = _remembering(lambda w: tuple(places[b] for b in buckets_of(w) if b in places))
            for batch in batches:
                found = [
                    sorted(set().union(*map(weighted, words_of(t)))) for t in batch["text"].to_pylist()
                ]
                yield {"places": [np.array(f, "<i4").tobytes() for f in found]}

        alike = by_task(self.texts, "places binary", convert).groupBy("places")
        alike = by_task(alike.agg(F.count(F.lit(1)).alias("n")), _PACKED, _packs)
        sets = written(alike, "weighted-sets")
        if (sets.agg(F.sum("sets")).first()[0] or 0) <= SETS:
            rows = _unpacked([r.asDict() for r in sets.collect()])
            return lambda model: _sums(rows, model)

        def in_tasks(model: np.ndarray) -> np.ndarray:
            def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
                total = np.zeros((2, len(model) + 1), np.int64)
                for batch in batches:
                    total += _sums(_unpacked(batch.to_pylist()), model)
                yield {"sums": [total.tobytes()]}

            found = by_task(sets, "sums binary", partial).collect()
            nothing = np.zeros((2, len(model) + 1), np.int64)
            return sum((np.frombuffer(r["sums"], np.int64).reshape(2, -1) for r in found), nothing)

        return in_tasks


class Listed:
    """Documents at hand, as :class:`Examples`."""

    def __init__(self, documents: Iterable[np.ndarray]) -> None:
        self.documents = list(documents)

    def counts(self) -> tuple[int, np.ndarray]:
        every = np.concatenate([*self.documents, np.zeros(0, np.int32)])
        return len(self.documents), np.bincount(every, minlength=BUCKETS)

    def within(self, columns: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        position = np.full(BUCKETS, -1)
        position[columns] = np.arange(len(columns))
        found = [position[d] for d in self.documents]
        rows = _Rows([f[f >= 0] for f in found], np.ones(len(found), np.int64))
        return lambda model: _sums(rows, model)


def train(
    positive: Examples | Iterable[np.ndarray], unlabelled: Examples | Iterable[np.ndarray], prior: float
) -> Model:
    """Descent on the non-negative risk with logistic losses, over all examples.

    Where the estimated cost of the non-toxic part falls below nothing, which only
    overfitting can bring about, the step undoes that part instead. Only buckets that are
    clearly more frequent in toxic than in unlabelled text get a weight: others would be
    learned by heart.
    """
    positive, unlabelled = (x if isinstance(x, Examples) else Listed(x) for x in (positive, unlabelled))
    (n_p, have), (n_u, usual) = positive.counts(), unlabelled.counts()
    columns = _telling(n_p, have, n_u, usual)
    p, u = positive.within(columns), unlabelled.within(columns)
    ones = np.append(have[columns], n_p) / max(n_p, 1)
    model = np.append(np.zeros(len(columns)), math.log(prior / (1 - prior)))
    slope, square, total = np.zeros(len(model)), np.zeros(len(model)), np.zeros(len(model))
    for step in range(1, STEPS + 1):
        # Means of calling z toxic by weight, and last of log(1 + e^z), the cost of calling it
        # non-toxic; calling it toxic costs log(1 + e^-z).
        p_one, u_one = _fraction(p(model)) / max(n_p, 1), _fraction(u(model)) / max(n_u, 1)
        clean = u_one[-1] - prior * p_one[-1]
        gradient = u_one[:-1] - prior * p_one[:-1]
        if clean >= 0:
            gradient = gradient + prior * (p_one[:-1] - ones)
        else:
            gradient = -gradient
        gradient[:-1] += DECAY * model[:-1]
        slope = 0.9 * slope + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        scale = np.sqrt(square / (1 - 0.999**step)) + 1e-8
        model = model - RATE * slope / (1 - 0.9**step) / scale
        total = total + model * (step > STEPS // 2)
    # The mean of the later steps, as undoing makes them go to and fro.
    model = total / (STEPS - STEPS // 2)
    weights = np.zeros(BUCKETS)
    weights[columns] = model[:-1]
    return Model(weights, float(model[-1]))


def _telling(n_p: int, have: np.ndarray, n_u: int, usual: np.ndarray) -> np.ndarray:
    """Buckets whose share of the toxic examples is ``CLEARLY`` standard errors above their
    share of the unlabelled ones, and which at least ``LEAST_EXAMPLES`` of the former have."""
    usual = (usual + 0.5) / (n_u + 1)
    error = np.sqrt(usual * (1 - usual) / n_p)
    clearly = have / n_p - usual >= CLEARLY * error
    return np.flatnonzero(clearly & (have >= LEAST_EXAMPLES))


class _Rows:
    """Sets of positions end to end, and how many documents have each set."""

    def __init__(self, sets: list[np.ndarray], n: Iterable[int], sizes: np.ndarray | None = None) -> None:
        self.n = np.array(n, np.int64)
        sizes = np.array([len(s) for s in sets], np.int64) if sizes is None else sizes
        self.rows = np.repeat(np.arange(len(self.n)), sizes)
        self.at = np.concatenate([*sets, np.zeros(0, np.int32)])


# Sets end to end, thousands in a row, so that a step does not go through them one by one.
_PACKED, PACK = "sets long, places binary, sizes binary, n binary", 1 << 12


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
    for batch in batches:
        for at in range(0, batch.num_rows, PACK):
            some = batch.slice(at, PACK)
            places = some["places"].to_pylist()
            yield {
                "sets": [len(places)],
                "places": [b"".join(places)],
                "sizes": [np.array([len(p) // 4 for p in places], "<i8").tobytes()],
                "n": [some["n"].to_numpy().astype("<i8").tobytes()],
            }


def _unpacked(packs: list[dict[str, object]]) -> _Rows:
    places, sizes, n = (
        np.frombuffer(b"".join(p[name] for p in packs), kind)
        for name, kind in (("places", "<i4"), ("sizes", "<i8"), ("n", "<i8"))
    )
    return _Rows([places], n, sizes)


def _sums(rows: _Rows, model: np.ndarray) -> np.ndarray:
    """Of all documents, the probabilities by weight and bias, and log(1 + e^z), in whole units and
    what these leave over in whole squares of units."""
    out = np.bincount(rows.rows, model[rows.at], len(rows.n)) + model[-1]
    one, cost = _whole(_sigmoid(out)) * rows.n, _whole(np.logaddexp(0, out)) * rows.n
    total = np.zeros((2, len(model) + 1), np.int64)
    for k in (0, 1):
        np.add.at(total[k], rows.at, one[k][rows.rows])
    total[:, -2], total[:, -1] = one.sum(1), cost.sum(1)
    return total


def _whole(values: np.ndarray) -> np.ndarray:
    units = values * _UNIT
    return np.stack((np.rint(units), np.rint((units - np.rint(units)) * _UNIT))).astype(np.int64)


def _fraction(total: np.ndarray) -> np.ndarray:
    return total[0] / _UNIT + total[1] / _UNIT**2


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -50, 50)))


def scorer(model: Model | None) -> Callable[[list[bytes]], np.ndarray]:
    """A function from texts to scores from 0 to 1, higher where toxic is likelier."""
    if model is None:
        return lambda texts: np.zeros(len(texts))
    weights = {int(i): float(model.weights[i]) for i in np.flatnonzero(model.weights)}
    weighted = _remembering(lambda w: tuple(b for b in buckets_of(w) if b in weights))

    def score(texts: list[bytes]) -> np.ndarray:
        sums = [
            math.fsum(map(weights.__getitem__, set().union(*map(weighted, words_of(t)))))
            for t in texts
        ]
        return _sigmoid(np.array(sums, float) + model.bias)

    return score


def scored(docs: DataFrame, model: Model | None, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` (1 from ``threshold``) of every document.

    Null and empty texts get the score of a text without words; without a model all score 0.
    Copies score alike. Extra columns are not read.
    """
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), utf8("text"))

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        score = scorer(model)
        for batch in batches:
            found = score(batch["text"].to_pylist())
            yield {
                "doc_id": batch["doc_id"],
                "score": found,
                "predicted": (found >= threshold).astype(np.int32),
            }

    return by_task(texts, "doc_id long, score double, predicted int", convert)


def keep_clean(docs: DataFrame, model: Model | None, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below ``threshold``.

    Texts go to Python and a flag comes back; no row is shuffled.
    """
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = scorer(model)
        for texts in batches:
            yield pd.Series(score(list(texts)) < threshold)

    names = [f"__column_{i}" for i in range(len(docs.columns))]
    text = utf8(names[docs.columns.index("text")])
    return docs.toDF(*names).filter(clean(text)).toDF(*docs.columns)
