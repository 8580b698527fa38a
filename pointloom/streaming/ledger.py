"""Job states as an append-only table; the present state is a fold over it."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Job states and the prefix of job names in listings.
QUEUED, RUNNING, COMPLETED, FAILED = "Queued", "Running", "Completed", "Failed"
NAME_PREFIX = "job-"

LEDGER_SCHEMA = (
    "job_id string, status string, result_path string, silhouette_score double, "
    "error string, ts timestamp, source string, stream string, batch_id bigint, step int, "
    "position int"
)
# Changes in the order they were made: by time, and at one time as they were written.
ORDER = ("ts", "batch_id", "step", "position")


class Change(NamedTuple):
    """A job enters a state; what is not known at that time stays None."""

    job_id: str
    status: str
    ts: datetime
    result_path: str | None = None
    silhouette_score: float | None = None
    error: str | None = None
    source: str | None = None


def append_changes(
    spark: SparkSession,
    ledger_path: str,
    stream: str,
    batch_id: int,
    step: int,
    changes: Sequence[Change],
) -> int:
    """Record the next state changes of a stream batch; returns the step that follows.

    They go to a folder named by stream, batch and step, which is overwritten, so a batch that
    runs again after a failure replaces its rows and adds none, and streams never meet.
    """
    if not changes:
        return step
    rows = [(*change, stream, batch_id, step, i) for i, change in enumerate(changes)]
    fields = [*Change._fields, "stream", "batch_id", "step", "position"]
    schema = {f.split()[0]: f for f in LEDGER_SCHEMA.split(", ")}
    folder = f"{_changes(ledger_path)}/stream={stream}/batch={batch_id}/step={step}"
    written = spark.createDataFrame(rows, ", ".join(schema[f] for f in fields))
    written.coalesce(1).write.mode("overwrite").parquet(folder)
    return step + 1


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """All state changes; empty where nothing was recorded yet."""
    reader = spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", True)
    try:
        return reader.parquet(ledger_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def compact_ledger(spark: SparkSession, ledger_path: str) -> int:
    """Put the changes of finished batches into few files; returns how many folders went.

    The last batch of each stream stays, as it may run again. The new files are there before
    the old ones go. If that is cut short, changes may be read twice, which no fold minds, and the
    next compaction removes what was left.
    """
    ledger = read_ledger(spark, ledger_path)
    last = ledger.groupBy("stream").agg(F.max("batch_id").alias("last"))
    # A row per stream.
    old = ledger.join(F.broadcast(last), "stream").filter("batch_id < last").drop("last")
    folders = [
        f"{_changes(ledger_path)}/stream={r['stream']}/batch={r['batch_id']}"
        for r in old.select("stream", "batch_id").distinct().collect()
    ]
    system = spark._jvm.org.apache.hadoop.fs.Path(ledger_path).getFileSystem(
        spark._jsc.hadoopConfiguration()
    )
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f) for f in folders]
    paths = [p for p in paths if system.exists(p)]
    if not paths:
        return 0
    packed = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger_path.rstrip('/')}/packed")
    before = [f.getPath() for f in system.listStatus(packed)] if system.exists(packed) else []
    rows = old.select([f.split()[0] for f in LEDGER_SCHEMA.split(", ")]).distinct()
    rows.write.parquet(f"{ledger_path.rstrip('/')}/packed/{uuid.uuid4().hex}")
    for path in [*paths, *before]:
        system.delete(path, True)
    return len(paths)


def _changes(ledger_path: str) -> str:
    return f"{ledger_path.rstrip('/')}/changes"


def current_jobs(ledger: DataFrame, order_by: Sequence[str] = ORDER) -> DataFrame:
    """One row per job: last status, last known path, score and error, first time seen.

    A later null never hides an earlier value, and a change that is there twice counts once.
    ``max_by`` combines on the map side, so a job that holds most of the rows still shuffles one
    row per split. As its values are texts, each split sorts its rows by job to combine them.
    """
    order = F.struct(*order_by)

    def last(name: str) -> Column:
        return F.max_by(name, order).alias(name)

    def last_known(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), order)).alias(name)

    return ledger.groupBy("job_id").agg(
        last("status"),
        last_known("result_path"),
        last_known("silhouette_score"),
        last_known("error"),
        F.min("ts").alias("created_at"),
    )


def find_job(ledger: DataFrame, job_id: str, order_by: Sequence[str] = ORDER) -> DataFrame:
    """The present state of one job, no row if unknown.

    The filter on the grouping key is pushed below the fold into the scan.
    """
    return current_jobs(ledger, order_by).filter(F.col("job_id") == F.lit(job_id))


def recorded_runs(ledger: DataFrame, order_by: Sequence[str] = ORDER) -> DataFrame:
    """The jobs of a ledger as runs that :func:`list_jobs` takes, under their prefixed names."""
    ended = F.col("status").isin(COMPLETED, FAILED)
    return current_jobs(ledger, order_by).select(
        F.concat(F.lit(NAME_PREFIX), "job_id").alias("name"),
        F.col("status").alias("state"),
        F.when(F.col("status") == FAILED, F.lit(FAILED))
        .when(ended, F.lit("Succeeded"))
        .otherwise(F.lit("Creating"))
        .alias("provisioning_state"),
        F.col("created_at").alias("created"),
    )


def list_jobs(runs: DataFrame) -> DataFrame:
    """Listing of runs by ``name``: those named as jobs, in whatever state, with the id
    that is left when the prefix is taken out wherever it occurs."""
    return runs.filter(F.col("name").startswith(NAME_PREFIX)).select(
        F.replace("name", F.lit(NAME_PREFIX), F.lit("")).alias("job_id"),
        "name",
        "state",
        "provisioning_state",
        "created",
    )
