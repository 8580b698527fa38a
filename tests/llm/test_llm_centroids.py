from __future__ import annotations

import hashlib
import math
import random

from conftest import plan_of
from corpus_cases import multiset
from pyspark.sql import functions as F

from pointloom.llm import centroids


def made(seed=3, n=300):
    rng = random.Random(seed)
    middles = [[rng.uniform(-2, 2) for _ in range(64)] for _ in range(9)]
    rows = [(i, [m + rng.gauss(0, 0.3) for m in middles[i * i % 9]]) for i in range(n)]
    rows += [rows[5], rows[5], (rows[7][0], rows[8][1]), (None, rows[9][1]), (None, [0.0] * 64)]
    rows += [(900 + i, rows[11][1]) for i in range(90)]  # copies
    bad = (None, [], [1.0] * 63, [1.0] * 65, [1.0] * 63 + [None], [1.0] * 63 + [math.nan],
           [math.inf] + [1.0] * 63, [1.0] * 63 + [-math.inf])
    return rows, [(2000 + i, v) for i, v in enumerate(bad)]


def table(spark, rows, kind="double"):
    plain = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(5)
    return plain.select("*", *[F.lit("extra").alias(n) for n in ("VEC_ID", "v", "cluster", "best")])


def distance(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def nearest(v, middles):
    return min((distance(v, c), i) for i, c in enumerate(middles))


def plain(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    key = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    middles = [v for _, v in sorted(kept, key=key)[:k]]
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v, middles)[1], []).append(v)
        for c, vs in groups.items():
            middles[c] = [sum(x) // len(vs) for x in zip(*vs)]
    best = [(i, *nearest(v, middles)) for i, v in kept]
    inertia = {c: sum(d for _, d, b in best if b == c) for _, _, c in best}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middles]
    return [(i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, d, c in best]


def test_equals_plain_code(spark):
    good, bad = made()
    found = centroids.measured(centroids.clustered(table(spark, [*good, *bad])))
    assert multiset(map(tuple, found.collect())) == multiset(plain(good))


def test_fewer_vectors_than_centroids_and_empty_clusters(spark):
    good = [(i, [float(i % 2)] * 64) for i in range(5)]
    found = centroids.measured(centroids.clustered(table(spark, good)))
    assert multiset(map(tuple, found.collect())) == multiset(plain(good))


def test_single_precision(spark):
    good = [(i, [(i * j % 17 - 8) / 8 for j in range(64)]) for i in range(40)]
    found = centroids.measured(centroids.clustered(table(spark, good, "float")))
    assert multiset(map(tuple, found.collect())) == multiset(plain(good))


def test_nothing_kept(spark):
    for rows in ([], made()[1]):
        found = centroids.measured(centroids.clustered(table(spark, rows)))
        assert found.collect() == []
        assert found.columns[:3] == ["vec_id", "cluster", "distance"]


def test_assignment_is_one_stage_without_python(spark):
    kept = centroids.quantised(table(spark, made()[0]))
    plan = plan_of(kept.select(centroids.nearest([[0] * 64, [1] * 64])))
    assert "Python" not in plan and plan.count("Exchange") == 1  # that of the test's own table
