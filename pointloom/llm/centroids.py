"""Centroid clustering of vectors in whole numbers, by Spark's own expressions.

Vectors become integers once. The distance to a centroid, a constant array, is ``aggregate``
over ``zip_with``; ``array_min`` over structs of distance and number chooses the cluster;
sums of the components by cluster, generated code, give the next centroids. Whatever the order of
rows, sums of integers are the same, so that runs agree to the last digit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import pick, written

SIZE, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, 1

Centroids = list[list[int]]


def quantised(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v``: floor(scale * x) of each component of ``embedding``, for vectors of
    just ``size`` components, none of them null or not finite; others are left out."""
    x = F.col("embedding")
    finite = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    )
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    return (
        pick(vectors, "vec_id", "embedding")
        .filter((F.size(x) == size) & finite)
        .select(F.col("vec_id").cast("long"), whole.cast("array<bigint>").alias("v"))
    )


def first_centroids(kept: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> Centroids:
    """The vectors with the smallest SHA-256 of seed and id; fewer where there are fewer.

    A null id counts as no text. Rows of one id are told apart by their components.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.orderBy(key, "v").limit(k).collect()  # k rows
    return [list(r["v"]) for r in rows]


def _literal(centroids: Centroids) -> str:
    return ", ".join(f"array({', '.join(f'{x}L' for x in c)})" for c in centroids)


def nearest(centroids: Centroids) -> Column:
    """A struct of the ``distance`` of ``v`` to the nearest centroid, squared, and the number
    of its ``cluster``, the smaller among equally near ones."""
    return F.expr(
        f"array_min(transform(array({_literal(centroids)}), (c, i) -> struct("
        "aggregate(zip_with(v, c, (a, b) -> (a - b) * (a - b)), 0L, (s, d) -> s + d) AS distance, "
        "i AS cluster)))"
    )


def updated(kept: DataFrame, centroids: Centroids) -> Centroids:
    """The floor of the mean of each cluster's vectors; an empty cluster's centroid stays.

    A split sends at most k rows of sums, however large a cluster is; the driver gets k.
    """
    size = len(centroids[0])
    placed = kept.select(nearest(centroids)["cluster"].alias("cluster"), "v")
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(size)]
    found = list(centroids)
    for row in placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        found[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(size)]
    return found


class Clustering(NamedTuple):
    """``placed`` has ``vec_id``, ``cluster`` and ``distance`` of every kept vector."""

    placed: DataFrame
    centroids: Centroids


def clustered(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED
) -> Clustering:
    """Cluster by ``rounds`` updates from :func:`first_centroids`, and one more assignment.

    Reads ``vec_id`` and ``embedding``, whatever other columns there are. Vectors of another
    length, null ones and those with components that are null or not finite give no rows; rows
    alike are vectors each; equal vectors may begin several clusters, of which the first gets
    all. A null ``vec_id`` stays null. No kept vectors give no rows and no centroids. Distances
    beyond a long raise Spark's overflow error rather than wrap.
    """
    kept = written(quantised(vectors), "vectors")
    centroids = first_centroids(kept, k, seed)
    if not centroids:
        nothing = kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clustering(nothing, centroids)
    for _ in range(rounds):
        centroids = updated(kept, centroids)
    best = kept.select("vec_id", nearest(centroids).alias("best"))
    placed = best.select("vec_id", "best.cluster", "best.distance")
    return Clustering(written(placed, "clusters"), centroids)


def digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def measured(found: Clustering) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` (sums of distances
    over a cluster and over all) and ``centroid_sha256``.

    The sums are k rows, which become constants.
    """
    rows = found.placed.groupBy("cluster").agg(F.sum("distance").alias("sum")).collect()
    inertia = {r["cluster"]: r["sum"] for r in rows}
    k = range(len(found.centroids))
    by_cluster = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in k]).cast("array<bigint>")
    digests = F.array(*[F.lit(digest(c)) for c in found.centroids]).cast("array<string>")
    return found.placed.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(by_cluster, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.get(digests, F.col("cluster")).alias("centroid_sha256"),
    )
