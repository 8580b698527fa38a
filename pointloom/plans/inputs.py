"""Point tables derived from the test tables by fixed formulas.

Each formula exists once as a DataFrame and once as SQL for the oracle. Every input
covers its whole table, so the work of a query grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.session import scratch_dir

REFERENCE = (34.0522, -118.2437)

# Start of the checked k-means updates and of the nearest-center query.
START = [(5.0, 20.0, 5.0), (25.0, 50.0, 5.0), (45.0, 90.0, 5.0)]

# Splits that the order lines are dealt to for a fit: their file is one that Spark cannot split.
SPLITS = 16

# Order of the state changes below.
CHANGE_ORDER = ("ts", "seq")


def with_magnitudes(centers: list[tuple[float, ...]]) -> list[tuple[float, ...]]:
    """Centers of ``x, y, z`` as centers of a point cloud's features."""
    return [(*c, sum(v * v for v in c) ** 0.5) for c in centers]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(key: Column, values: tuple[int, int, int]) -> Column:
    group = key % 3
    return F.when(group == 0, values[0]).when(group == 1, values[1]).otherwise(values[2])


def blob_columns(key: str) -> list[Column]:
    """Three far-apart groups of points, planted by ``key % 3``."""
    k = F.col(key)
    return [
        (_pick(k, (0, 100, -80)) + k % 7).cast("double").alias("x"),
        (_pick(k, (0, 50, 90)) + k % 5).cast("double").alias("y"),
        (k % 11).cast("double").alias("z"),
    ]


def blob_sql(key: str) -> str:
    return (
        f"CAST(CASE {key} % 3 WHEN 0 THEN 0 WHEN 1 THEN 100 ELSE -80 END + {key} % 7 AS DOUBLE) AS x, "
        f"CAST(CASE {key} % 3 WHEN 0 THEN 0 WHEN 1 THEN 50 ELSE 90 END + {key} % 5 AS DOUBLE) AS y, "
        f"CAST({key} % 11 AS DOUBLE) AS z"
    )


def put_again(spark: SparkSession, uploads: str, path: str, rows: DataFrame) -> None:
    """Replace an uploaded file by another of the same name."""
    staging = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark, "put-again"))
    rows.coalesce(1).write.option("header", True).csv(staging.toString())
    system = staging.getFileSystem(spark._jsc.hadoopConfiguration())
    (written,) = [
        f.getPath() for f in system.listStatus(staging) if f.getPath().getName().startswith("part-")
    ]
    # The path in the form that the folder was given in.
    plain = spark._jvm.org.apache.hadoop.fs.Path(uploads).toUri().getPath()
    target = spark._jvm.org.apache.hadoop.fs.Path(uploads + path[path.index(plain) + len(plain) :])
    system.delete(target, False)
    system.rename(written, target)


def pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per order line; the groups in it are not separable."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("x"),
        (F.col("l_extendedprice") / 1000.0).alias("y"),
        (F.col("l_discount") * 100.0).alias("z"),
    )


PTS = (
    "SELECT l_orderkey, l_linenumber, l_quantity AS x, "
    "l_extendedprice / CAST(1000 AS DOUBLE) AS y, l_discount * CAST(100 AS DOUBLE) AS z "
    "FROM lineitem"
)


def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", *blob_columns("c_custkey"))


BLOBS = f"SELECT c_custkey, {blob_sql('c_custkey')} FROM customer"


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points all over the globe."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        ((key * 37) % 18000 / 100.0 - 90.0).alias("lat"),
        ((key * 101) % 36000 / 100.0 - 180.0).alias("lon"),
    )


GEO = (
    "SELECT c_custkey, (c_custkey * 37) % 18000 / CAST(100 AS DOUBLE) - 90 AS lat, "
    "(c_custkey * 101) % 36000 / CAST(100 AS DOUBLE) - 180 AS lon FROM customer"
)


def rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in three distance rings around the reference point."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        (REFERENCE[0] - _pick(key, (0, 20, 60)) - key % 10 / 100.0).alias("lat"),
        F.lit(REFERENCE[1]).alias("lon"),
    )


RINGS = (
    f"SELECT c_custkey, CAST({REFERENCE[0]} AS DOUBLE) "
    "- CASE c_custkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 20 ELSE 60 END "
    "- c_custkey % 10 / CAST(100 AS DOUBLE) AS lat, "
    f"CAST({REFERENCE[1]} AS DOUBLE) AS lon FROM customer"
)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blobs with a missing x, a NaN x and a missing note in one row of ten each."""
    rest = F.col("c_custkey") % 10
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        *[
            F.when(rest == 0, F.lit(None)).when(rest == 1, F.lit(float("nan"))).otherwise(c).alias("x")
            if i == 0
            else c
            for i, c in enumerate(blob_columns("c_custkey"))
        ],
        F.when(rest != 2, F.col("c_mktsegment")).alias("note"),
    )


DIRTY = (
    "SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN CAST('NaN' AS DOUBLE) "
    "ELSE x END AS x, y, z, CASE WHEN c_custkey % 10 <> 2 THEN c_mktsegment END AS note "
    f"FROM (SELECT c_custkey, c_mktsegment, {blob_sql('c_custkey')} FROM customer)"
)


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without coordinate names: key and text are no features, the rest is."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        ((key % 3).cast("int") * 10000 + F.col("p_size")).alias("size"),
        F.col("p_retailprice").alias("price"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a compute service: one per event, some of them no jobs."""
    kind, event = F.col("event_type"), F.col("event_id").cast("string")
    return table(spark, sf_dir, "events").select(
        F.when(kind == "view", F.concat(F.lit("web-"), event))
        .when(kind == "click", F.concat(F.lit("job-retry-job-"), event))
        .otherwise(F.concat(F.lit("job-"), event))
        .alias("name"),
        kind.alias("state"),
        F.when(kind == "error", F.lit("Failed")).otherwise(F.lit("Succeeded")).alias(
            "provisioning_state"
        ),
        F.col("ts").alias("created"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as state changes: the user is the job."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("job_id"),
        kind.alias("status"),
        F.when(kind == "purchase", F.concat(F.lit("outputs/"), F.col("event_id"))).alias("result_path"),
        F.when(kind == "purchase", F.col("value")).alias("silhouette_score"),
        F.when(kind == "error", F.col("props")).alias("error"),
        "ts",
        F.col("event_id").alias("seq"),
    )


CHANGES = (
    "SELECT CAST(user_id AS VARCHAR) AS job_id, event_type AS status, "
    "CASE WHEN event_type = 'purchase' THEN 'outputs/' || event_id END AS result_path, "
    "CASE WHEN event_type = 'purchase' THEN value END AS silhouette_score, "
    "CASE WHEN event_type = 'error' THEN props END AS error, ts, event_id AS seq FROM events"
)
