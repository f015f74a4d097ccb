"""Session settings and the shared folder that staged tables and checkpoints live in."""

from __future__ import annotations

import functools
import math
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's partition even where that takes one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # One hot session in a micro-batch is merged map-side before it is shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # INT96 (the default) carries no row-group statistics, so timestamp filters could not skip.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

SHUFFLE_BYTES = 256 * 1024**2


def build_session(app_name: str = "signalloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_settings(spark: SparkSession) -> SparkSession:
    """Set the run-time options the operators rely on, on a session built elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def stored_bytes(spark: SparkSession, path: str) -> int:
    fs, where = hadoop_path(spark, path)
    return fs.getContentSummary(where).getLength()


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the number of shuffle partitions to one per 256 MB of input.

    The number is only ever raised: adaptive execution joins small partitions again, but it cannot
    split an aggregation's partition that is too large. Returns the number in effect.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(current, math.ceil(input_bytes / SHUFFLE_BYTES))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", wanted)
    return wanted


@functools.cache
def _local_shared_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="signalloom-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local folder is only ever made up for a local master (tests).
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_shared_folder(spark.sparkContext.applicationId)
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def hadoop_path(spark: SparkSession, path: str):
    """The file system that ``path`` is on, and its path object."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def scratch_path(spark: SparkSession, label: str, below: str | None = None) -> str:
    """A path that nothing else uses, in the shared folder unless ``below`` names another."""
    return f"{below or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
