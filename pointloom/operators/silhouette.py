"""Silhouette score, squared Euclidean, in two aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from pointloom.functions import column


def silhouette(
    df: DataFrame, columns: Sequence[str], label: str = "cluster"
) -> float | None:
    """Mean silhouette over all rows, or None with fewer than two clusters.

    The mean squared distance from a row to a cluster of size N is the squared distance
    to the cluster's mean plus the cluster's own variance (summed over the features),
    times N/(N-1) for the row's own cluster. So the first pass brings size, mean and
    variance per cluster, k rows, and the second averages an expression; no pair of rows
    is ever formed, and large coordinates do not cancel out.
    """
    names = list(columns)
    stats = [F.count(F.lit(1)).alias("size")]
    for i, name in enumerate(names):
        value = column(name).cast("double")
        stats += [F.avg(value).alias(f"mean_{i}"), F.var_pop(value).alias(f"var_{i}")]
    clusters = df.groupBy(column(label).alias("label")).agg(*stats).collect()
    if len(clusters) < 2:
        return None
    return _measured(df, clusters, names, label).agg(F.avg(_score()).alias("score")).first()["score"]


def _score() -> Column:
    """Of one row, from ``own`` and ``other``."""
    own, other = F.col("own"), F.col("other")
    score = F.when(own < other, 1 - own / other).when(own > other, other / own - 1)
    return F.when(own.isNull(), F.lit(0.0)).otherwise(F.coalesce(score, F.lit(0.0)))


def _measured(df: DataFrame, clusters: list[Row], names: list[str], label: str) -> DataFrame:
    """``own`` and ``other``: mean squared distance of a row to the rest of its cluster (null
    if it is alone there) and to the nearest other cluster.

    The statistics are constant arrays, so the expression has the same size for any number of
    clusters. The own cluster's are taken out by its place, in generated code; one pass over the
    arrays finds the nearest other.
    """
    values = [_array([row[f"mean_{i}"] for row in clusters]) for i in range(len(names))]
    spread = _array([sum(row[f"var_{i}"] for i in range(len(names))) for row in clusters])
    rest = _array([row["size"] / (row["size"] - 1) if row["size"] > 1 else None for row in clusters])
    place = F.array_position(F.array(*[F.lit(row["label"]) for row in clusters]), column(label))
    rows = df.select(
        (place - 1).cast("int").alias("place"),
        *[column(name).cast("double").alias(f"x{i}") for i, name in enumerate(names)],
    )

    def distance(at: str) -> str:
        gaps = [f"(x{i} - {mean}[{at}])" for i, mean in enumerate(values)]
        return " + ".join(f"{gap} * {gap}" for gap in gaps)

    return rows.select(
        F.expr(f"({distance('place')} + {spread}[place]) * {rest}[place]").alias("own"),
        F.expr(
            f"array_min(transform({spread}, (v, i) -> IF(i = place, NULL, {distance('i')} + v)))"
        ).alias("other"),
    )


def _array(values: list[float | None]) -> str:
    return "array(" + ", ".join("NULL" if v is None else f"{float(v)!r}D" for v in values) + ")"
