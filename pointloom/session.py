"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app_name: str = "pointloom", **conf) -> SparkSession:
    """A session with the few settings the jobs rely on.

    On a cluster also set ``spark.default.parallelism`` (a few times the reducers a
    k-row shuffle needs, not the number of input splits): MLlib's k-means sizes the
    shuffle of each iteration by it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the shared folder the cluster names.

    ``spark.checkpoint.dir`` is the only place used on a cluster; a machine-local
    folder is taken only in local mode, where driver and executors share the disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="pointloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
