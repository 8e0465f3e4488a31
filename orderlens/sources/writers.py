"""Sinks for the order table and the customer table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import profit_units
from orderlens.operators.storage import store
from orderlens.plans.tables import customer_churn
from orderlens.schemas import (
    ORDER_COLUMNS,
    PEOPLE_COLUMNS,
    present_columns,
    require_columns,
)


def save_tables(clean: DataFrame, people: DataFrame | None, folder: str) -> DataFrame:
    """Write the order table, and the customer table if given; read the orders back."""
    path = save_version(clean, folder, "clean")
    if people is not None:
        save_people(people, folder)
    return clean.sparkSession.read.schema(clean.schema).parquet(path)


def save_people(people: DataFrame, folder: str) -> str:
    return save_version(people, folder, "people")


def save_version(df: DataFrame, folder: str, name: str) -> str:
    """Write a table as a new version and return its path.

    A version never overwrites an older one, which the table may have been derived from and which
    others may be reading; readers take the newest version that carries a success marker.
    """
    path = f"{folder}/{name}/version={time.time_ns():020d}"
    df.write.parquet(path)
    return path


def published_orders(clean: DataFrame) -> DataFrame:
    """The contract columns and the row profit."""
    require_columns(clean, ORDER_COLUMNS, "the order table")
    profit = profit_units().cast("double") / F.lit(100.0)
    return clean.select(*ORDER_COLUMNS, profit.alias("profit"))


def published_people(people: DataFrame, clean: DataFrame) -> DataFrame:
    """The customer columns that exist and the customer's churn label."""
    require_columns(people, ["segment"], "the customer table")
    kept = people.select(*present_columns(people, PEOPLE_COLUMNS))
    return kept.join(customer_churn(clean), "customer_id", "left")


def publish_table(df: DataFrame, name: str, folder: str) -> None:
    """Replace a catalog table in one step.

    The rows become a new version below ``folder``; only when all of it is committed does the table's location
    change. A job that fails, or tasks that are run again, leave the old table as it is. A table with other
    columns has to be dropped and made anew.
    """
    spark = df.sparkSession
    path = save_version(df, folder, name)
    stored = spark.read.parquet(path)
    if spark.catalog.tableExists(name) and spark.table(name).schema == stored.schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def remove_versions(spark: SparkSession, folder: str, name: str, keep: int = 2) -> list[str]:
    """Remove all but the newest ``keep`` complete versions of a table, and incomplete ones older than these.

    Call it when no reader of an older version is left. Returns the removed paths.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    versions = sorted((e.getPath() for e in files.listStatus(path)), key=lambda p: p.getName())
    whole = [p for p in versions if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    kept = whole[-max(1, keep) :]
    gone = [p for p in versions if kept and p.getName() < kept[0].getName()]
    for p in gone:
        files.delete(p, True)
    return [p.toString() for p in gone]


def publish_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    connections: int = 8,
    batch_rows: int = 5000,
) -> None:
    """Replace a database table, ``batch_rows`` per insert batch.

    ``connections`` bounds the writers the database sees at one time. The rows are
    stored first, so that only the insertion runs in that few tasks.
    """
    (
        store(df, "publish")
        .coalesce(connections)
        .write.mode("overwrite")
        .option("batchsize", batch_rows)
        .jdbc(url, table, properties=properties)
    )
