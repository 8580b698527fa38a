"""One query per operator over the test tables; ``oracles`` holds the matching SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom import operators as op
from pointloom.functions import column
from pointloom.plans import inputs
from pointloom.plans.cluster_job import run_job
from pointloom.session import scratch_dir
from pointloom.sources import preview, read_metrics, read_points, write_metrics
from pointloom.streaming import (
    current_jobs,
    find_job,
    intake,
    list_jobs,
    read_ledger,
    recorded_runs,
)

Query = Callable[[SparkSession, str], DataFrame]

XYZ = ["x", "y", "z"]
CLOUD = [*XYZ, "magnitude"]


def _rounded(name: str, digits: int = 6):
    return F.round(column(name), digits).alias(name)


def _one_row(spark: SparkSession, **values) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(n) for n, v in values.items()])


def _with_magnitude(df: DataFrame) -> DataFrame:
    return op.add_features(df, op.choose_features(df))


def _as_csv(df: DataFrame, purpose: str) -> str:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("header", True).csv(path)
    return path


# Scans, sinks, cleaning


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_points(spark, _as_csv(inputs.table(spark, sf_dir, "customer"), "csv-scan"))


def results_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = scratch_dir(spark, "results")
    job = run_job(spark, inputs.blobs(spark, sf_dir), output)
    written = read_points(spark, f"{output}/results.csv")
    return op.canonical_ids(written, job.centers).select(
        F.col("c_custkey").cast("bigint"), *XYZ, _rounded("magnitude"), "cluster"
    )


def metrics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = scratch_dir(spark, "metrics")
    write_metrics(spark, _planted_score(spark, sf_dir), output)
    return read_metrics(spark, output).select(_rounded("silhouette_score"))


def preview_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = inputs.pts(spark, sf_dir)
    return preview(points, 5, order_by=points.columns)


def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.drop_incomplete(inputs.dirty(spark, sf_dir))


# Features


def magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _with_magnitude(inputs.pts(spark, sf_dir))
    return points.select("l_orderkey", "l_linenumber", *XYZ, _rounded("magnitude"))


def haversine_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = inputs.geo(spark, sf_dir)
    located = op.add_features(points, op.choose_features(points), inputs.REFERENCE)
    return located.select("c_custkey", "lat", "lon", _rounded("distance_to_center_km"))


def feature_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features chosen for each kind of table, with their mean over the whole table."""
    balance = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    cloud, geo = inputs.blobs(spark, sf_dir), inputs.geo(spark, sf_dir)
    tables = {
        "cloud": cloud,
        "cloud+intensity": cloud.withColumn("intensity", F.col("z") / 10),
        "geo": geo,
        "geo+elevation": geo.withColumn("elevation", F.col("c_custkey") % 13),
        "cloud+geo": cloud.withColumns({"lat": F.col("y") / 2, "lon": F.col("x") / 2}),
        "upper case": cloud.select("c_custkey", *[F.col(c).alias(c.upper()) for c in XYZ]),
        "numeric": balance,
        "mixed": inputs.mixed(spark, sf_dir),
    }
    return reduce(DataFrame.union, [_feature_means(name, df) for name, df in tables.items()])


def _feature_means(name: str, df: DataFrame) -> DataFrame:
    features = op.choose_features(df)
    names = features.columns
    rows = op.add_features(df, features, inputs.REFERENCE)
    means = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(column(c).cast("double")).alias(f"mean_{i}") for i, c in enumerate(names)],
    )
    per_feature = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("feature"),
                F.round(F.col(f"mean_{i}"), 6).alias("mean"),
            )
            for i, c in enumerate(names)
        ]
    )
    return means.select(
        F.lit(name).alias("source"), F.lit(features.kind).alias("kind"), "n_rows",
        F.inline(per_feature),
    )


def numeric_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = inputs.table(spark, sf_dir, "part")
    return part.select(*op.choose_features(part).columns)


def vector_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    vectors = op.assemble(_with_magnitude(inputs.pts(spark, sf_dir)), CLOUD)
    return vectors.select(
        "l_orderkey",
        "l_linenumber",
        F.posexplode(vector_to_array("features")).alias("position", "value"),
    ).withColumn("value", F.round("value", 6))


# Clustering


def assign_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.assign_nearest(inputs.pts(spark, sf_dir), XYZ, inputs.START)


def kmeans_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled, centers = op.cluster_points(_with_magnitude(inputs.blobs(spark, sf_dir)), CLOUD)
    return op.canonical_ids(labelled, centers).select("c_custkey", "cluster")


def kmeans_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = inputs.rings(spark, sf_dir)
    features = op.choose_features(points)
    located = op.add_features(points, features, inputs.REFERENCE)
    labelled, centers = op.cluster_points(located, features.columns)
    return op.canonical_ids(labelled, centers).select(
        "c_custkey", _rounded("distance_to_center_km"), "cluster"
    )


def kmeans_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    with op.staged(inputs.pts(spark, sf_dir), XYZ) as points:
        centers = op.lloyd_steps(points, XYZ, inputs.START, 3)
    return centers.select("cluster", "n", *[_rounded(c) for c in XYZ])


def _planted_score(spark: SparkSession, sf_dir: str) -> float | None:
    rows = _with_magnitude(inputs.blobs(spark, sf_dir))
    return op.silhouette(rows.withColumn("cluster", F.col("c_custkey") % 3), CLOUD)


def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_row(spark, silhouette_score=round(_planted_score(spark, sf_dir), 6))


def silhouette_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = op.silhouette(assign_nearest(spark, sf_dir), XYZ)
    return _one_row(spark, silhouette_score=round(score, 6))


def silhouette_undefined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All points alike: one cluster, no score, and the rows still come labelled."""
    alike = inputs.table(spark, sf_dir, "customer").select(
        "c_custkey", *[F.lit(1.0).alias(c) for c in XYZ]
    )
    job = run_job(spark, alike)
    return job.labelled.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("cluster").alias("n_clusters"),
        F.lit(job.score is not None).alias("has_score"),
    )


# Whole job


def cluster_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV in, incomplete rows dropped, results and metrics written, rows labelled."""
    source = _as_csv(inputs.dirty(spark, sf_dir), "points")
    job = run_job(spark, source, scratch_dir(spark, "job"))
    return op.canonical_ids(job.labelled, job.centers).select(
        F.col("c_custkey").cast("bigint"), *XYZ, "note", _rounded("magnitude"), "cluster"
    )


def cluster_job_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _as_csv(inputs.rings(spark, sf_dir), "rings")
    job = run_job(spark, source, scratch_dir(spark, "job"), reference=inputs.REFERENCE)
    return op.canonical_ids(job.labelled, job.centers).select(
        F.col("c_custkey").cast("bigint"), _rounded("distance_to_center_km"), "cluster"
    )


def cluster_job_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = run_job(spark, inputs.mixed(spark, sf_dir))
    return op.canonical_ids(job.labelled, job.centers)


def cluster_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on every order line: sizes and means of the labelled groups, which overlap, and
    the score. All 20 updates from given centers, so that plain SQL can follow them."""
    job = run_job(
        spark,
        inputs.pts(spark, sf_dir),
        splits=inputs.SPLITS,
        start=inputs.with_magnitudes(inputs.START),
        tolerance=None,
    )
    return job.labelled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.round(F.avg(c), 6).alias(c) for c in CLOUD],
        F.lit(round(job.score, 6)).alias("silhouette_score"),
    )


# Ledger and intake


def ledger_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_jobs(inputs.changes(spark, sf_dir), inputs.CHANGE_ORDER)


def ledger_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_job(inputs.changes(spark, sf_dir), "7", inputs.CHANGE_ORDER)


def ledger_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_jobs(inputs.runs(spark, sf_dir))


def ledger_list_recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing of what a ledger has: the users' events again, their kinds as states."""
    states = {"view": "Queued", "click": "Running", "purchase": "Completed", "error": "Failed"}
    state = F.create_map(*[F.lit(x) for pair in states.items() for x in pair])
    changes = inputs.changes(spark, sf_dir)
    changes = changes.withColumn("status", F.coalesce(state[F.col("status")], F.lit("Queued")))
    return list_jobs(recorded_runs(changes, inputs.CHANGE_ORDER))


def planted_labels(labelled: DataFrame) -> DataFrame:
    """For each planted group of a job how many labels it has, and whether no two groups of the
    job have the same: one label everywhere, or groups that ran together, show."""
    groups = labelled.groupBy("job_id", "planted").agg(
        F.count(F.lit(1)).alias("n_labelled"),
        F.count_distinct("cluster").alias("n_labels"),
        F.min("cluster").alias("label"),
    )
    apart = groups.groupBy("job_id").agg(
        (F.count_distinct("label") == F.count(F.lit(1))).alias("apart")
    )
    return groups.join(apart, "job_id")


def upload_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables dropped as files, each file clustered as its own job, four at a time.

    Every table is written as it is split, so the number of uploads grows with the
    data; three of them share a folder, and the names of all begin alike. The nations carry text
    where a number belongs, so their jobs fail; then one of their files is put again under its name, with
    numbers for all nations, and the same stream runs it as a job of its own. Labels are held against the planted groups: one
    label for each group of a job, and no two groups of a job with the same.
    """
    root = scratch_dir(spark, "uploads")
    uploads, outputs, ledger = f"{root}/uploads", f"{root}/outputs", f"{root}/ledger"
    keys = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}
    for name, key in keys.items():
        points = inputs.table(spark, sf_dir, name).select(
            F.lit(name).alias("source"), F.col(key).alias("key"), *inputs.blob_columns(key)
        )
        points.write.mode("append").option("header", True).csv(f"{uploads}/points")
    inputs.table(spark, sf_dir, "nation").select(
        F.lit("nation").alias("source"), F.col("n_nationkey").alias("key"),
        F.col("n_name").alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"),
    ).write.mode("append").option("header", True).csv(uploads)

    def run() -> None:
        intake(
            spark, uploads, outputs, ledger, f"{root}/progress", files_per_batch=8, jobs_at_once=4
        ).awaitTermination()

    def plain(path):
        return F.regexp_replace(path, "^\\w+:/*", "/")

    def planted(path: str, schema: str) -> DataFrame:
        reader = spark.read.schema(schema).option("header", True)
        rows = reader.option("recursiveFileLookup", True).csv(path)
        return rows.withColumns(
            {"file": plain(F.col("_metadata.file_path")), "planted": F.col("key") % 3}
        )

    def uploaded(new: DataFrame, before: DataFrame | None = None) -> DataFrame:
        """What is in the files of new jobs, as a table, as the files may be put again."""
        jobs = new.select("job_id", plain(F.col("source")).alias("file")).distinct()
        if before is not None:
            jobs = jobs.join(before.select("job_id").distinct(), "job_id", "left_anti")
        rows = planted(uploads, "source string, key bigint, x string, y string, z string")
        counts = rows.groupBy("file", "source", "planted").agg(F.count(F.lit(1)).alias("n_uploaded"))
        path = scratch_dir(spark, "uploaded")
        counts.join(jobs, "file").write.parquet(path)
        return spark.read.parquet(path)

    run()
    first = uploaded(read_ledger(spark, ledger))
    inputs.put_again(
        spark, uploads, first.filter("source = 'nation'").agg(F.min("file")).first()[0],
        inputs.table(spark, sf_dir, "nation").select(
            F.lit("nation again").alias("source"), F.col("n_nationkey").alias("key"),
            *inputs.blob_columns("n_nationkey"),
        ),
    )
    run()
    files = first.unionByName(uploaded(read_ledger(spark, ledger), first))
    labelled = planted(
        f"{outputs}/*/results.csv",
        "source string, key bigint, x double, y double, z double, magnitude double, cluster int",
    ).withColumn("job_id", F.regexp_extract("file", "/outputs/([^/]+)/results.csv/", 1))
    jobs = current_jobs(read_ledger(spark, ledger)).select(
        "job_id", "status", F.col("silhouette_score").isNotNull().alias("scored")
    )
    return (
        files.join(jobs, "job_id", "left")
        .join(planted_labels(labelled), ["job_id", "planted"], "left")
        .groupBy("source", "planted", "status", "scored")
        .agg(
            F.sum("n_uploaded").alias("n_uploaded"),
            F.coalesce(F.sum("n_labelled"), F.lit(0)).alias("n_labelled"),
            F.coalesce(F.max("n_labels"), F.lit(0)).alias("labels_per_group"),
            F.coalesce(F.min("apart"), F.lit(False)).alias("groups_apart"),
        )
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        csv_scan,
        results_roundtrip,
        metrics_roundtrip,
        preview_top5,
        drop_incomplete,
        feature_set,
        magnitude,
        haversine_km,
        numeric_fallback,
        vector_assembly,
        assign_nearest,
        kmeans_cloud,
        kmeans_geo,
        kmeans_lloyd,
        silhouette,
        silhouette_lineitem,
        silhouette_undefined,
        cluster_job,
        cluster_job_geo,
        cluster_job_numeric,
        cluster_lineitem,
        ledger_current,
        ledger_lookup,
        ledger_list,
        ledger_list_recorded,
        upload_stream,
    )
}
