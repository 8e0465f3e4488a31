"""Intermediate results kept in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="orderlens-")
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/orderlens-{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as parquet and return the stored table.

    Cuts the lineage, so several passes cost one computation, and a lost executor
    costs a re-read. Later passes read only the columns they use.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
