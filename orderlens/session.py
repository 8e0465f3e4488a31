"""Session settings the plans are made for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Partition counts, join types and skewed partitions are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join without sorting where every part of the smaller side is measured to fit.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def open_session(name: str) -> SparkSession:
    """The running session, or a new one. Master, memory, ``spark.checkpoint.dir`` and
    ``spark.sql.shuffle.partitions`` are the cluster's to set."""
    builder = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
