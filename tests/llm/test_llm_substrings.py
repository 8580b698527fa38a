from __future__ import annotations

from collections import Counter

import numpy as np
from corpus_cases import SCHEMA, clean, multiset, rows, table

from pointloom.llm import substrings


def brute(made):
    seen = Counter()
    for row in made:
        words = clean(row[1])
        seen.update(tuple(words[i : i + 35]) for i in range(len(words) - 34))
    for row in made:
        words = clean(row[1])
        gone = set()
        for i in range(len(words) - 34):
            if seen[tuple(words[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        yield row[0], len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)


def found(df):
    return multiset(tuple(r) for r in substrings.without_repeats(df).collect())


def test_equals_brute_force_over_several_files(spark):
    made = rows()
    assert found(table(spark, made)) == multiset(brute(made))


def test_equals_brute_force_on_a_parquet_scan(spark, tmp_path):
    made = rows(2)
    path = str(tmp_path / "docs")
    spark.createDataFrame(made, SCHEMA).repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    assert found(docs) == multiset(brute(made))


def test_no_documents(spark):
    assert found(table(spark, [])) == []


def test_any_shift_shares_an_anchor():
    differences = {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER}
    assert differences == set(range(substrings.PERIOD))


def test_rolling_hash_is_that_of_the_run():
    values = np.random.default_rng(1).integers(0, 1 << 63, 50, np.uint64)
    for size in (1, 2, 15, 35, 50):
        one = [substrings.rolling(values[i : i + size], size)[0] for i in range(51 - size)]
        assert (substrings.rolling(values, size) == np.array(one)).all()
    assert len(substrings.rolling(values[:3], 15)) == 0


def test_messages_tell_repeats_of_a_chunk_once():
    chunk = substrings.Chunk(
        np.zeros(0, np.uint64), np.zeros(3, np.int64), np.full(3, 9), np.array([7, 7, 7]),
        np.array([0, 1, 2]), np.zeros(3, np.int64),
    )
    h = np.array([5, 6, 6, 5, 5, 8], np.uint64)
    doc, start = np.array([0, 0, 0, 1, 1, 2]), np.array([0, 1, 2, 0, 1, 0])
    sent = substrings._messages(chunk, h, np.zeros(6, np.int64), doc, start)
    kinds = Counter((sent["at"] & 3).tolist())
    assert kinds == {substrings._ASK: 1, substrings._TELL: 2, substrings._KNOWN: 2}
    known = sent["at"] & 3 == substrings._KNOWN
    spans = (sent["at"][known] >> 2 & (1 << 30) - 1).tolist()
    assert sorted(spans) == [2, 3]
