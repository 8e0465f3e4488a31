"""The measures of the dashboard, as ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import mean, profit_sum, ratio
from orderlens.operators import ranks
from orderlens.plans.sales import totals


def sales_measures(clean: DataFrame) -> DataFrame:
    out = totals(clean, profit_sum().alias("profit_total"))
    return out.withColumn("margin", ratio(F.col("profit_total"), F.col("gmv")))


def customer_measures(people: DataFrame) -> DataFrame:
    repeat = ratio(F.count_if(F.col("orders") >= 2), F.count("*"))
    counted = people.agg(F.count("*").alias("customers"), repeat.alias("repeat_share"))
    return counted.withColumn("ltv_median", F.lit(ranks.median(people, "gmv")).cast("double"))


def fraud_measure(clean: DataFrame) -> DataFrame:
    return clean.agg(mean("fraud_label").alias("fraud_share"))
