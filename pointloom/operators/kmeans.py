"""k-means: MLlib's start, updates as plain aggregations, labels as column expressions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructType

from pointloom.functions import column, squared_distance

Centers = list[list[float]]

# MLlib's defaults for the number of updates and the stopping distance.
MAX_ITERATIONS = 20
TOLERANCE = 1e-4

_DISTANCES = "__center_distances"


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Append the feature columns as one ML vector; nulls and NaN are an error."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


@contextmanager
def staged(
    df: DataFrame, columns: Sequence[str], splits: int | None = None
) -> Iterator[DataFrame]:
    """Just the named columns as doubles, kept on the executors while in use.

    The input is parsed once for all passes. Blocks that memory cannot hold go to disk;
    the blocks of a lost executor are read again from the scan. ``splits`` deals the rows
    out evenly first, which pays for an input of few, large splits (a file that cannot be split);
    otherwise the passes have the splits of the scan.
    """
    points = df.select([column(c).cast("double").alias(c) for c in columns])
    if splits is not None:
        points = points.repartition(splits)
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield points
    finally:
        points.unpersist()


def finite(columns: Sequence[str]) -> Column:
    """Whether all the columns are numbers a distance can be taken of."""
    values = [column(c).cast("double") for c in columns]
    return reduce(and_, [~F.isnan(v) & (F.abs(v) < float("inf")) for v in values])


def fit_kmeans(
    points: DataFrame,
    columns: Sequence[str],
    k: int = 3,
    seed: int = 1,
    start: Sequence[Sequence[float]] | None = None,
    max_iterations: int = MAX_ITERATIONS,
    tolerance: float | None = TOLERANCE,
) -> Centers:
    """Centers of MLlib's k-means with its defaults (features unscaled), at most k of them.

    Inputs of all sizes go the same way: MLlib chooses the start, unless one is given, and the
    updates are aggregations over the columns. Its own updates would cache an object of
    about 100 bytes per row; these need the memory of the staged columns. Hand in
    :func:`staged` points, they are read once per pass. Which start the seed gives depends on the
    splits of the points. Infinite coordinates are an error, found before the fit.
    """
    checked = points.agg(F.count(F.lit(1)).alias("n"), F.min(finite(columns)).alias("finite"))
    row = checked.first()
    if not row["n"]:
        raise ValueError("no complete rows to cluster")
    if not row["finite"]:
        raise ValueError(f"infinite coordinates: {', '.join(columns)} must be finite in all rows")
    if start is None:
        vectors = assemble(points, columns).select("features")
        # The block solver keeps no vectors for the start.
        model = KMeans(k=k, seed=seed, solver="block", maxIter=0).fit(vectors)
        start = [[float(v) for v in center] for center in model.clusterCenters()]
    return update_centers(points, columns, start, max_iterations, tolerance)[0]


def update_centers(
    points: DataFrame,
    columns: Sequence[str],
    centers: Sequence[Sequence[float]],
    max_iterations: int = MAX_ITERATIONS,
    tolerance: float | None = TOLERANCE,
) -> tuple[Centers, list[int]]:
    """Move each center to the mean of its rows until none moves further than ``tolerance``.

    Returns the centers and the number of rows averaged in the last update. An update is
    one aggregation: every split combines its rows to at most k partial sums in generated
    code, k rows reach the driver, and nothing but the points' columns is read. A center
    without rows stays where it is.
    """
    centers = [[float(v) for v in center] for center in centers]
    sizes = [0] * len(centers)
    sums = [F.count(F.lit(1)), *[F.sum(column(c).cast("double")) for c in columns]]
    for _ in range(max_iterations):
        rows = assign_nearest(points, columns, centers).groupBy("cluster").agg(*sums).collect()
        sizes = [0] * len(centers)
        furthest = 0.0
        for label, size, *total in rows:
            mean = [value / size for value in total]
            moved = sum((new - old) ** 2 for new, old in zip(mean, centers[label], strict=True))
            furthest = max(furthest, moved)
            sizes[label], centers[label] = size, mean
        if tolerance is not None and furthest <= tolerance**2:
            break
    return centers, sizes


def assign_nearest(
    df: DataFrame,
    columns: Sequence[str],
    centers: Sequence[Sequence[float]],
    output: str = "cluster",
) -> DataFrame:
    """Append the index of the nearest center; ties go to the lowest index.

    The centers are literals, so labelling is a projection in the scan's own stage: no
    vector, no shuffle, no Python. The distances are an array of their own so that they
    are computed once and the plan grows only with the number of centers.
    """
    distances = F.array(*[squared_distance(columns, c) for c in centers])
    nearest = F.array_position(_DISTANCES, F.array_min(_DISTANCES)) - 1
    return (
        df.withColumn(_DISTANCES, distances)
        .withColumn(output, nearest.cast("int"))
        .drop(_DISTANCES)
    )


def cluster_points(
    df: DataFrame,
    columns: Sequence[str],
    k: int = 3,
    seed: int = 1,
    output: str = "cluster",
    splits: int | None = None,
) -> tuple[DataFrame, Centers]:
    """Fit on ``df``; returns it labelled, with its ``features`` vector, and the centers."""
    with staged(df, columns, splits) as points:
        centers = fit_kmeans(points, columns, k, seed)
    return assign_nearest(assemble(df, columns), columns, centers, output), centers


def canonical_ids(
    df: DataFrame, centers: Sequence[Sequence[float]], label: str = "cluster"
) -> DataFrame:
    """Renumber labels by the sort order of their centers.

    Fitted numbering depends on the seed and on how rows are split; this one does not.
    """
    order = sorted(range(len(centers)), key=lambda i: tuple(centers[i]))
    rank = {old: new for new, old in enumerate(order)}
    ranks = F.array(*[F.lit(rank[i]) for i in range(len(centers))])
    return df.withColumn(label, F.get(ranks, column(label)))


def lloyd_steps(
    points: DataFrame, columns: Sequence[str], start: Sequence[Sequence[float]], steps: int
) -> DataFrame:
    """Centers after a fixed number of updates from given ones, one row per center:
    ``cluster``, ``n`` (rows averaged last) and the feature columns."""
    centers, sizes = update_centers(points, columns, start, steps, tolerance=None)
    schema = StructType().add("cluster", IntegerType()).add("n", LongType())
    for name in columns:
        schema = schema.add(name, DoubleType())
    rows = [(i, n, *center) for i, (n, center) in enumerate(zip(sizes, centers, strict=True))]
    return points.sparkSession.createDataFrame(rows, schema)
