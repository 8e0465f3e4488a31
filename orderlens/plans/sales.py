"""Amount, orders and average order value: in total, by dimension, by month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import money_sum, ratio
from orderlens.operators import ranks


def measures() -> list[Column]:
    """Amount and distinct orders.

    The one distinct count makes Spark shuffle by (group, order), so a group with a
    third of all orders is still spread over all tasks.
    """
    return [
        money_sum().cast("double").alias("gmv"),
        F.count_distinct("order_key").alias("orders"),
    ]


def distinct_n(df: DataFrame, column: str) -> Column:
    """Exact distinct count as a scalar subquery over one column."""
    return df.agg(F.count_distinct(column)).scalar()


def with_aov(df: DataFrame) -> DataFrame:
    return df.withColumn("aov", ratio(F.col("gmv"), F.col("orders")))


def totals(clean: DataFrame, *more: Column) -> DataFrame:
    """Measures of all orders, with further aggregates if given.

    The distinct count is a subquery of its own, so only order keys are shuffled and
    the sums stay map-side.
    """
    sums = clean.agg(money_sum().cast("double").alias("gmv"), *more)
    return with_aov(sums.withColumn("orders", distinct_n(clean, "order_key")))


def totals_with_spread(clean: DataFrame) -> DataFrame:
    """Totals with smallest, median and largest amount and the period covered."""
    spread = [
        F.min("order_value").cast("double").alias("money_min"),
        F.max("order_value").cast("double").alias("money_max"),
        F.min("order_date").alias("date_min"),
        F.max("order_date").alias("date_max"),
    ]
    middle = F.lit(ranks.median(clean, "order_value")).cast("double")
    return totals(clean, *spread).withColumn("money_median", middle)


def by_dimension(clean: DataFrame, name: str, keep_null: bool = False) -> DataFrame:
    """Measures per value of a column, largest amount first.

    ``keep_null`` decides whether orders without a value form a group.
    """
    rows = clean if keep_null else clean.where(F.col(name).isNotNull())
    return with_aov(rows.groupBy(name).agg(*measures())).orderBy(F.desc("gmv"), name)


def by_year_month(clean: DataFrame) -> DataFrame:
    rows = clean.where(F.col("order_date").isNotNull())
    year, month = F.year("order_date").alias("year"), F.month("order_date").alias("month")
    return with_aov(rows.groupBy(year, month).agg(*measures())).orderBy("year", "month")
