"""Session settings the library relies on: UTC, ANSI casts, AQE."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library assumes.  ANSI makes bad casts fail the
# job (the landing layer is strict); UTC pins ``timestamp → date``.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# How much larger a table's rows are than its Parquet files, for the warehouse's jobs.  Spark plans
# broadcasts by the files' bytes: a dimension of a million rows in a few MB of files would be
# gathered, as rows and again as a hash table, by the driver.
SCAN_FACTOR = {"spark.sql.sources.fileCompressionFactor": "8.0"}

# What one task of the warehouse's jobs reads, in compressed bytes: postings take ten times as much as
# rows of a sort, and Spark's own sizes (128 and 64 MB) make a task's sort outgrow its memory and spill
# once the tables are large enough to fill them.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": "32m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}

# A starting profile for a large cluster (hundreds of executors, ~100 TB of
# input): many initial shuffle partitions that AQE coalesces towards the
# advisory size, so a partition fits an executor's memory at any scale;
# large scan splits; skew handling for hot keys in sort-merge joins.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str | None = None, app_name: str = "hiremart",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, profile: str = "local") -> SparkSession:
    """Create (or reuse) a session with the library's settings applied.

    ``profile="cluster"`` adds ``CLUSTER_CONF`` (partition sizing for large
    inputs); explicit ``shuffle_partitions`` / ``extra`` still win.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    conf = dict(SESSION_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    for key, value in conf.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of SESSION_CONF to an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def prepare_warehouse(spark: SparkSession) -> SparkSession:
    """Session settings of the warehouse's jobs; a session that sets them itself keeps its own."""
    for key, value in SCAN_FACTOR.items():
        if float(spark.conf.get(key)) == 1.0:
            spark.conf.set(key, value)
    for key, value in TASK_BYTES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared scratch root named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder (HDFS/S3/…); it is read, not
    overridden; failing that, the context's own checkpoint folder.  Only where both
    are unset in a local session (unit tests) a fresh local folder is created and
    registered; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that driver and executors of {master} share")
        root = tempfile.mkdtemp(prefix="hiremart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch root for one job's output."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/hiremart/{name}-{uuid.uuid4().hex}"


__all__ = ["SESSION_CONF", "CLUSTER_CONF", "build_session", "configure", "ensure_checkpoint_dir",
           "scratch_path"]
