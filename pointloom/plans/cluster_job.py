"""The whole job: scan, clean, features, fit, score, label, write."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pointloom.operators.cleaning import drop_incomplete
from pointloom.operators.featureset import FeatureSet, add_features, choose_features
from pointloom.operators.kmeans import MAX_ITERATIONS, TOLERANCE, assign_nearest, fit_kmeans, staged
from pointloom.operators.silhouette import silhouette
from pointloom.sources.points import read_points
from pointloom.sources.results import write_metrics, write_results

# Columns a job adds, which an input must not bring along.
RESERVED = ("features", "cluster")


class JobResult(NamedTuple):
    """Labelled rows, score (None if undefined), features used and fitted centers."""

    labelled: DataFrame
    score: float | None
    features: FeatureSet
    centers: list[list[float]]


def run_job(
    spark: SparkSession,
    source: str | DataFrame,
    output: str | None = None,
    reference: tuple[float, float] = (0.0, 0.0),
    k: int = 3,
    seed: int = 1,
    schema: StructType | str | None = None,
    file_format: str = "csv",
    splits: int | None = None,
    start: Sequence[Sequence[float]] | None = None,
    max_iterations: int = MAX_ITERATIONS,
    tolerance: float | None = TOLERANCE,
) -> JobResult:
    """Cluster the points of a table (a path or a DataFrame).

    Fit and score read staged feature columns, so the input is parsed once for them. The
    full rows pass through once more, from scan to label to writer, in one stage without
    a shuffle. So a DataFrame as source is computed twice; write one that is costly to
    compute to a table first. With ``output`` the results and then the metrics are written
    there: metrics mean that the results are complete. ``splits`` deals the staged rows out
    anew; ``start``, centers in the order of the features, takes the place of the seeded start.
    """
    table = source if isinstance(source, DataFrame) else read_points(
        spark, source, schema, file_format
    )
    _refuse_reserved(table)
    features = choose_features(table)
    rows = add_features(drop_incomplete(table), features, reference)
    names = list(features.columns)

    with staged(rows, features.stored, splits) as points:
        points = features.complete(points)
        centers = fit_kmeans(points, names, k, seed, start, max_iterations, tolerance)
        score = silhouette(assign_nearest(points, names, centers), names)

    labelled = assign_nearest(rows, names, centers)
    if output:
        write_results(labelled, output)
        write_metrics(spark, score, output)
    return JobResult(labelled, score, features, centers)


def _refuse_reserved(table: DataFrame) -> None:
    """Names count as the session compares them."""
    exact = table.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    taken = [c for c in table.columns if (c if exact else c.lower()) in RESERVED]
    if taken:
        raise ValueError(f"input already has columns named {', '.join(taken)}")
