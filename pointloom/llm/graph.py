"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (
        both.filter("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b > least").select(F.col("b").alias("a"), "least")
    return moved.union(least).toDF("a", "b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(``a``, ``b``) pairs of longs, in any order, to (``node``, ``root``): the smallest
    node that each node with a link can reach, itself included.

    A round joins links with one row per node; nodes with very many links are split by the
    adaptive skew join, and their minimum is combined before the shuffle. Each round is
    written to the shared folder; their number grows with the logarithm of the longest path.
    """
    links = written(
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        # Stars are all that neither kind of round changes any more.
        state = links.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("links"),
        ).first()
        if state == before:
            break
        before = state
        links = written(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
