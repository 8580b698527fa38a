from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator

from pointloom.operators import add_features, assemble, assign_nearest, choose_features, silhouette
from pointloom.plans import inputs


def brute_force(rows):
    """All pairs of a handful of points, by definition."""
    scores = []
    for i, (label, p) in enumerate(rows):
        def mean(other):
            d = [math.dist(p, q) ** 2 for j, (l, q) in enumerate(rows) if l == other and j != i]
            return sum(d) / len(d) if d else None

        a = mean(label)
        b = min(mean(l) for l in {l for l, _ in rows} - {label})
        scores.append(0.0 if a is None or a == b else 1 - a / b if a < b else b / a - 1)
    return sum(scores) / len(scores)


@pytest.mark.parametrize(("seed", "k", "offset"), [(1, 2, 0.0), (2, 3, -5.0), (3, 5, 1e3)])
def test_against_all_pairs(spark, seed, k, offset):
    rng = random.Random(seed)
    rows = [
        (rng.randrange(k), [offset + rng.gauss(0, 3) + 4 * (i % k) for _ in range(3)])
        for i in range(40)
    ]
    rows.append((k, [offset + 50.0, 1.0, 2.0]))  # alone in its cluster
    df = spark.createDataFrame([(l, *p) for l, p in rows], "cluster int, a double, b double, c double")
    assert silhouette(df, ["a", "b", "c"]) == pytest.approx(brute_force(rows), abs=1e-9)


def test_equals_the_evaluator(spark):
    points = inputs.pts(spark, "/root/testdata/sf0.01")
    points = add_features(points, choose_features(points))
    names = ["x", "y", "z", "magnitude"]
    labelled = assign_nearest(points, names, [[*c, 50.0] for c in inputs.START])
    evaluator = ClusteringEvaluator(predictionCol="cluster")
    assert silhouette(labelled, names) == pytest.approx(
        evaluator.evaluate(assemble(labelled, names)), abs=1e-9
    )


def test_many_clusters(spark):
    df = spark.sql(
        "SELECT CAST(id % 200 AS INT) AS cluster, CAST(id % 200 AS DOUBLE) * 3 + id % 7 AS a, "
        "CAST(id % 11 AS DOUBLE) AS b FROM range(4000)"
    )
    evaluator = ClusteringEvaluator(predictionCol="cluster")
    expected = evaluator.evaluate(assemble(df, ["a", "b"]))
    assert silhouette(df, ["a", "b"]) == pytest.approx(expected, abs=1e-9)


def test_two_distinct_points(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 9.0)], "cluster int, a double")
    assert silhouette(df, ["a"]) == pytest.approx(2 / 3)


def test_every_row_alone(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 9.0)], "cluster int, a double")
    assert silhouette(df, ["a"]) == 0.0


@pytest.mark.parametrize("rows", [[], [(0, 1.0)], [(0, 1.0), (0, 2.0)]])
def test_undefined_below_two_clusters(spark, rows):
    assert silhouette(spark.createDataFrame(rows, "cluster int, a double"), ["a"]) is None


def test_far_from_the_origin(spark):
    """Metre grids have coordinates in the millions; the score must not drown in them."""
    near = [(g, g * 10.0 + i % 5, float(i % 3)) for i in range(30) for g in (0, 1)]
    far = [(g, a + 4.0e6, b + 5.0e6) for g, a, b in near]
    schema = "cluster int, a double, b double"
    scores = [silhouette(spark.createDataFrame(r, schema), ["a", "b"]) for r in (near, far)]
    assert scores[0] == pytest.approx(scores[1], abs=1e-9)


def test_other_label_types_and_names(spark):
    df = spark.createDataFrame([("p", 1.0), ("p", 1.0), ("q", 9.0)], "`my label` string, `a.b` double")
    assert silhouette(df, ["a.b"], "my label") == pytest.approx(2 / 3)


def test_any_number_of_clusters(spark):
    df = spark.sql(
        "SELECT CAST(id % 1500 AS INT) AS cluster, CAST(id % 1500 AS DOUBLE) * 3 + id % 7 AS a, "
        "CAST(id % 11 AS DOUBLE) AS b FROM range(5000)"
    )
    evaluator = ClusteringEvaluator(predictionCol="cluster")
    expected = evaluator.evaluate(assemble(df, ["a", "b"]))
    assert silhouette(df, ["a", "b"]) == pytest.approx(expected, abs=1e-9)
