"""Point tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_points(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    file_format: str = "csv",
) -> DataFrame:
    """Scan a point table from any path or URI Spark can read.

    CSV files have a header; types are inferred unless ``schema`` is given, which
    saves one whole pass over the files.
    """
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
