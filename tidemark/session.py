"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# What the engine relies on. UTC keeps zoned and zone-less timestamps comparable;
# AQE coalesces, splits skewed joins and splits hot days when a table is written.
ENGINE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Suggested on a cluster, on top of the above. Not forced on a session we were given.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def local_session(cpus: int | str = "*", name: str = "tidemark", **settings: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**ENGINE_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A new folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session may fall back to
    a folder of this machine; on a cluster that would lose data silently.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"
    if re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        return tempfile.mkdtemp(prefix="run-", dir="/tmp")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
