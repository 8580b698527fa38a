from __future__ import annotations

import random

import numpy as np
import xxhash
from corpus_cases import SCHEMA, clean, lower, multiset, rows, table

from pointloom.llm import graph, simhash


def plain_fingerprint(text):
    words = clean(lower(text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(made):
    prints = [plain_fingerprint(r[1]) for r in made]
    label = list(range(len(made)))
    for _ in made:
        before = list(label)
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 2:
                    label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    least = {}
    for row, c in zip(made, label):
        if row[0] is not None:
            least[c] = min(least.get(c, row[0]), row[0])
    return [(r[0], f"{p:016x}", least.get(c), c) for r, p, c in zip(made, prints, label)]


def test_equals_brute_force(spark):
    made = rows()
    found = simhash.near_duplicates(table(spark, made)).select(
        "doc_id", simhash.hex_digits("fp"), "component_id"
    )
    assert multiset(map(tuple, found.collect())) == multiset(r[:3] for r in plain_components(made))


def test_one_document_of_each_component_stays(spark):
    made = rows()
    kept = simhash.keep_one_of_each(table(spark, made))
    assert kept.columns == table(spark, made).columns
    found = kept.toDF("a", *[f"c{i}" for i in range(len(kept.columns) - 1)]).collect()
    least = {label: c for _, _, c, label in plain_components(made)}
    assert multiset(r["a"] for r in found) == multiset(least.values())


def test_texts_of_a_table_are_not_moved(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{tmp_path}/documents")
    kept = simhash.keep_one_of_each(spark.read.parquet(f"{tmp_path}/documents"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert plan.count("ArrowEvalPython") == 1  # looks up file and row; fingerprints are made before
    assert kept.count() == len({c for *_, c in plain_components(rows())})


def test_no_documents(spark):
    empty = table(spark, [])
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_one_of_each(empty).collect() == []


def test_trie_finds_exactly_the_near_pairs():
    rng = random.Random(3)
    values = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        for _ in range(20):
            value = base
            for _ in range(rng.randrange(4)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    values = np.array(sorted(values), np.uint64)
    for bits in (0, 1, 2, 3):
        pairs = set()
        for a, b in simhash.trie_pairs(values, np.array([0]), np.array([len(values)]), bits):
            some = list(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist()))
            assert pairs.isdisjoint(some)
            pairs.update(some)
        apart = np.bitwise_count(values[:, None] ^ values[None])
        assert pairs == set(zip(*(x.tolist() for x in np.nonzero(np.triu(apart <= bits, 1)))))


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(1000, 1001 + i) for i in range(50)]
    rest = [(-5, -9), (-9, -5), (7000, 7000), (2**62, -(2**62))]
    edges = chain + star + rest
    found = dict(map(tuple, graph.connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    expected = {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(51)}
    expected |= {-5: -9, -9: -9, 2**62: -(2**62), -(2**62): -(2**62)}
    assert found == expected


def test_many_near_copies_give_no_pairs_but_a_forest(spark):
    near = [(1 << i) | (1 << j) for i in range(64) for j in range(i)]
    prints = spark.createDataFrame([(simhash.signed(v),) for v in near], "fp long")
    assert simhash.links(prints).count() <= 6 * len(near)
