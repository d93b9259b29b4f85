"""Session settings and the shared folder for written state."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str = "8", app: str = "loginwatch") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's checkpoint folder.

    Only a local session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a shared folder")
        base = tempfile.mkdtemp(prefix="loginwatch-")
    return os.path.join(base, "loginwatch", purpose, uuid.uuid4().hex)


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the table.

    For results that several later steps read, such as the triage queue: they are
    computed once, survive lost executors, and come back with file statistics.
    """
    path = shared_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
