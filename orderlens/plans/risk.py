"""Fraud rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import percent
from orderlens.plans.sales import measures


def fraud_overall(clean: DataFrame) -> DataFrame:
    """Share per row, fraud rows, all rows."""
    return clean.agg(
        percent(F.sum("fraud_label"), F.count("fraud_label"), 2).alias("fraud_pct"),
        F.sum("fraud_label").alias("fraud_rows"),
        F.count("*").alias("rows_n"),
    )


def fraud_by(clean: DataFrame, name: str, keep_null: bool = False) -> DataFrame:
    """Fraud rows per distinct order for each value of a column, highest rate first."""
    rows = clean if keep_null else clean.where(F.col(name).isNotNull())
    groups = rows.groupBy(name).agg(*measures(), F.sum("fraud_label").alias("fraud_n"))
    rate = percent(F.col("fraud_n"), F.col("orders"), 2)
    return groups.withColumn("fraud_pct", rate).orderBy(F.desc("fraud_pct"), name)
