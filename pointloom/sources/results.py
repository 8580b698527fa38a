"""Results and metrics of a job: writers, reader, preview.

Both outputs are folders written by the executors, named like the file a reader would
ask Spark for: ``<output>/results.csv`` and ``<output>/metrics.json``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.functions import column

METRICS_SCHEMA = "silhouette_score double"


def write_results(df: DataFrame, output: str, file_format: str = "csv") -> str:
    """Write all columns but feature vectors; returns the folder written."""
    path = f"{output.rstrip('/')}/results.{file_format}"
    vectors = [f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)]
    rows = df.select([column(c) for c in df.columns if c not in vectors]) if vectors else df
    writer = rows.write.mode("overwrite").format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def write_metrics(spark: SparkSession, score: float | None, output: str) -> str:
    """Write the score as one JSON row, or no row where it is undefined.

    The empty folder of an undefined score replaces the metrics of an earlier run.
    """
    path = f"{output.rstrip('/')}/metrics.json"
    rows = spark.range(0, 0 if score is None else 1, 1, 1)
    metrics = rows.select(F.lit(score).cast("double").alias("silhouette_score"))
    metrics.write.mode("overwrite").json(path)
    return path


def read_metrics(spark: SparkSession, output: str) -> DataFrame:
    """The score of a job as one row; null if metrics are missing or unreadable."""
    path = f"{output.rstrip('/')}/metrics.json"
    try:
        metrics = spark.read.schema(METRICS_SCHEMA).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        metrics = spark.createDataFrame([], METRICS_SCHEMA)
    return metrics.agg(F.first("silhouette_score", ignorenulls=True).alias("silhouette_score"))


def preview(df: DataFrame, rows: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """A few rows: any, or the first in the given order (a top-k, not a full sort)."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(rows)
