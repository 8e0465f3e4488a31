from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, before)


@pytest.fixture
def orders_of(spark):
    """Order rows from (transaction, customer, day or timestamp, amount)."""

    def make(rows, **constants):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(
            rows, "transaction_id string, customer_id string, order_date string, order_value string"
        ).coalesce(1)
        df = df.withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))
        df = df.withColumn("order_value", F.col("order_value").cast("decimal(18,2)"))
        df = df.withColumn("order_key", F.col("transaction_id"))
        for name, value in constants.items():
            df = df.withColumn(name, F.lit(value))
        return df

    return make
