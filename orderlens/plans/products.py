"""Profit and margin: in total, by product, by category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import money_sum, percent, profit_sum
from orderlens.plans.sales import measures, with_aov


def margin(clean: DataFrame) -> DataFrame:
    return clean.agg(
        F.count_distinct("product_id").alias("sku"),
        money_sum().cast("double").alias("gmv"),
        profit_sum().alias("profit"),
    ).withColumn("margin_pct", percent(F.col("profit"), F.col("gmv"), 1))


def by_product(clean: DataFrame) -> DataFrame:
    """Every product, largest amount first, margin unrounded."""
    return _margins(clean.where(F.col("product_id").isNotNull()), "product_id", None)


def top_products(clean: DataFrame, rows: int = 10) -> DataFrame:
    return _margins(clean, "product_id", 1).limit(rows)


def by_category(clean: DataFrame) -> DataFrame:
    """Every category but the missing one, margin unrounded."""
    return _margins(clean.where(F.col("category").isNotNull()), "category", None)


def by_category_with_null(clean: DataFrame) -> DataFrame:
    return _margins(clean, "category", 1)


def _margins(clean: DataFrame, name: str, digits: int | None) -> DataFrame:
    groups = clean.groupBy(name).agg(*measures(), profit_sum().alias("profit"))
    share = percent(F.col("profit"), F.col("gmv"), digits)
    return with_aov(groups).withColumn("margin_pct", share).orderBy(F.desc("gmv"), name)
