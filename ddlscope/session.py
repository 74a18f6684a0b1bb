"""Session settings and the shared folder for data that has to outlive a stage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where that costs one more shuffle after it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench. On a cluster the session comes from the job's own submit settings."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("ddlscope")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (builder.config("spark.driver.memory", memory)
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions)).getOrCreate())


def apply_settings(spark: SparkSession) -> None:
    """Give a session that comes from elsewhere, as on a cluster, those of the settings that a running session takes: the
    adaptive ones, which split hot keys."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.adaptive.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def sized_settings(input_bytes: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings that give a job over this much data partitions that fit in memory. Adaptive execution merges small
    partitions but does not split those of a range partitioning, so their number has to follow the data."""
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.files.maxPartitionBytes": str(partition_bytes)}


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, as the cluster names it in `spark.checkpoint.dir`.

    A folder of this machine is made only for a local session that names none; a cluster without one is an error,
    because its executors could not read each other's files."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="ddlscope-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
