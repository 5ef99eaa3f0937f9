"""Session settings the loads rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings, valid for any session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the aggregation above then needs its own
    # shuffle; partial aggregation runs before it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Join by hash instead of sorting both sides where, after the shuffle, every
    # partition of the smaller side turns out to be below this size.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors can reach, as the cluster names it in
    ``spark.checkpoint.dir``. Only a local session falls back to a new
    temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="tidemark-")
