"""Uploads as a stream: every arriving file is a job of its own.

A file source would tell files by their paths alone, so one that is put again under a used name
would never be run. So each start lists the upload folder and announces what the stream has not had
yet, by path, time and length; the announcements are the files that the stream reads."""

from __future__ import annotations

import hashlib
import json
import re
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pointloom.plans.cluster_job import run_job
from pointloom.streaming.ledger import (
    COMPLETED,
    FAILED,
    QUEUED,
    RUNNING,
    Change,
    append_changes,
)

# The binary file source lists files; its content column is never selected, so
# uploads are not opened to learn their names.
UPLOAD_SCHEMA = "path string, modificationTime timestamp, length bigint"
LISTING_SCHEMA = f"{UPLOAD_SCHEMA}, content binary"


def job_id_of(
    path: str, uploads: str = "", modified: datetime | None = None, length: int | None = None
) -> str:
    """An id for the file at a path: what its name below the upload folder reads like, and a
    hash of that name, and of time and length if they are given, so that no two uploads share an
    id and one keeps its own."""
    folder = f"{without_scheme(uploads).rstrip('/')}/"
    name = without_scheme(path)
    if uploads and name.startswith(folder):
        name = name[len(folder) :]
    readable = re.sub(r"[^A-Za-z0-9.]+", "-", name).strip("-.")[:60]
    if modified is not None:
        name = f"{name}\n{_utc(modified).isoformat()}\n{length}"
    return f"{readable}-{hashlib.sha256(name.encode()).hexdigest()[:16]}"


def without_scheme(path: str) -> str:
    return re.sub(r"^\w+:/*", "/", path)


def literal_path(path: str) -> str:
    """A path that Spark reads as it stands, without globbing."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def intake(
    spark: SparkSession,
    uploads: str,
    outputs: str,
    ledger_path: str,
    checkpoint: str,
    files_per_batch: int = 1,
    jobs_at_once: int = 1,
    **job_options,
) -> StreamingQuery:
    """Start a query that runs :func:`run_job` once per upload and stops when none is left.

    Uploads come in the order of their times; an empty file makes no job. A file that is put again
    with another time or length is a job of its own, under an id of its own, and the results
    of both stand; one that is replaced before it is run is run as it is then. Results go to
    ``<outputs>/<job id>``. A job that fails is recorded with its error and the next one
    goes on. Up to ``jobs_at_once`` jobs of a batch run at the same time. ``job_options`` are
    handed to the job (reference point, k, seed, schema).
    """
    announced = f"{checkpoint.rstrip('/')}/announced"
    announce(spark, uploads, announced, files_per_batch)
    stream = (
        spark.readStream.schema(f"{UPLOAD_SCHEMA}, turn string")
        .option("maxFilesPerTrigger", 1)
        .parquet(announced)
    )

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        arrived = batch.orderBy("modificationTime", "path")
        stream = stream_id(spark, checkpoint)
        run_uploads(
            arrived, stream, batch_id, uploads, outputs, ledger_path, job_options, jobs_at_once
        )

    return (
        stream.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def announce(spark: SparkSession, uploads: str, announced: str, files_per_batch: int = 1) -> int:
    """Write what the upload folder has and no announcement names yet, ``files_per_batch`` uploads a
    file, in the order of their times; returns how many uploads are new.

    A start that is cut short here has announced all, some or nothing; the next one adds the rest.
    """
    reader = spark.read.format("binaryFile").schema(LISTING_SCHEMA)
    listing = reader.option("recursiveFileLookup", True).load(uploads).filter("length > 0")
    known = _announcements(spark, announced)
    new = listing.select("path", "modificationTime", "length").join(
        known, ["path", "modificationTime", "length"], "left_anti"
    )
    # At most one name per upload that is not run yet.
    rows = new.orderBy("modificationTime", "path").collect()
    begun = _now().strftime("%Y%m%dT%H%M%S%f")
    turns = [(*row, f"{begun}-{i // files_per_batch:09d}") for i, row in enumerate(rows)]
    table = spark.createDataFrame(turns, f"{UPLOAD_SCHEMA}, turn string")
    # One task writes the files, one after the other.
    ordered = table.coalesce(1).sortWithinPartitions("turn")
    ordered.write.mode("append").partitionBy("turn").parquet(announced)
    return len(rows)


def _announcements(spark: SparkSession, announced: str) -> DataFrame:
    try:
        return spark.read.schema(UPLOAD_SCHEMA).option("recursiveFileLookup", True).parquet(announced)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], UPLOAD_SCHEMA)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a stream with its checkpoint: the same after a restart, another
    for a new checkpoint, at the old place too."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


def run_uploads(
    arrived: DataFrame,
    stream: str,
    batch_id: int,
    uploads: str,
    outputs: str,
    ledger_path: str,
    job_options: dict,
    jobs_at_once: int = 1,
) -> None:
    """Run the jobs of one batch, ``jobs_at_once`` at a time, noting each change of state.

    The end of some jobs and the beginning of the next are written together, which keeps the
    ledger at one file for each time that jobs begin, and one per batch.
    """
    spark = arrived.sparkSession
    # At most files_per_batch names.
    files = [
        (job_id_of(f["path"], uploads, f["modificationTime"], f["length"]), f)
        for f in arrived.collect()
    ]
    changes = [
        Change(job_id, QUEUED, min(_utc(file["modificationTime"]), _now()), source=file["path"])
        for job_id, file in files
    ]

    def run(upload) -> Change:
        job_id, file = upload
        output = f"{outputs.rstrip('/')}/{job_id}"
        try:
            score = run_job(spark, literal_path(file["path"]), output, **job_options).score
            return Change(job_id, COMPLETED, _now(), output, score, source=file["path"])
        except Exception as error:  # any failure belongs to this job alone
            reason = f"{type(error).__name__}: {error}"
            return Change(job_id, FAILED, _now(), error=reason, source=file["path"])

    step = 0
    with ThreadPoolExecutor(jobs_at_once) as pool:
        for at in range(0, len(files), jobs_at_once):
            some = files[at : at + jobs_at_once]
            changes += [Change(job_id, RUNNING, _now(), source=f["path"]) for job_id, f in some]
            step = append_changes(spark, ledger_path, stream, batch_id, step, changes)
            changes = list(pool.map(inheritable_thread_target(spark)(run), some))
    append_changes(spark, ledger_path, stream, batch_id, step, changes)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _utc(ts: datetime) -> datetime:
    return ts.astimezone(timezone.utc)
