"""Repeat purchases, lifetime value and churn slices over the customer table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions import mean, percent
from orderlens.operators import ranks
from orderlens.operators.storage import store
from orderlens.plans.tables import customer_churn


def people_summary(people: DataFrame) -> DataFrame:
    """Customers, repeaters and the spread of lifetime value."""
    return _summary(people)


def repeat_report(people: DataFrame) -> DataFrame:
    """The summary with the spread of order counts.

    N orders allow at most sqrt(2N) distinct order counts, so their median may use
    the built-in aggregate; amounts are near-unique and take the rank selection.
    """
    return _summary(
        people,
        F.min("orders").alias("purchases_min"),
        F.median("orders").alias("purchases_median"),
        F.max("orders").alias("purchases_max"),
    )


def repeat_report_averages(people: DataFrame) -> DataFrame:
    return people.agg(
        F.count("*").alias("customers"),
        F.min("orders").alias("purchases_min"),
        F.max("orders").alias("purchases_max"),
        F.round(mean("orders"), 1).alias("purchases_avg"),
        percent(_repeaters(), F.count("*"), 1).alias("repeat_pct"),
        F.min("gmv").cast("double").alias("ltv_min"),
        F.max("gmv").cast("double").alias("ltv_max"),
        F.round(mean("gmv"), 1).alias("ltv_avg"),
        F.round(F.sum("gmv").cast("double"), 0).alias("gmv_people"),
    )


def lower_medians(people: DataFrame) -> DataFrame:
    """Lower median of order counts and of lifetime value, one row each."""
    total = people.count()
    parts = [
        people.sparkSession.range(1).select(
            F.lit(metric).alias("metric"),
            F.lit(ranks.lower_median(people, column, total)).cast("double").alias("median_value"),
        )
        for metric, column in (("purchases", "orders"), ("ltv", "gmv"))
    ]
    return parts[0].unionByName(parts[1])


def churn_slice(clean: DataFrame, people: DataFrame) -> DataFrame:
    """Customers, medians and amount per churn label.

    Customers without a label form no row and are outside the customer share, but
    their amount stays in the total that the amount share refers to.
    """
    labelled = store(
        people.select("customer_id", "orders", "gmv").join(
            customer_churn(clean), "customer_id", "left"
        ),
        "labelled",
    )
    medians = ranks.grouped_medians(labelled, "churn_label", "gmv")
    ltv = F.lit(None).cast("double")
    for label, value in medians.items():
        ltv = F.when(F.col("churn_label") == label, value).otherwise(ltv)
    groups = labelled.groupBy("churn_label").agg(
        F.count("*").alias("customers"),
        F.median("orders").alias("purchases_median"),
        F.sum("gmv").cast("double").alias("gmv"),
    )
    known = F.col("churn_label").isNotNull()
    everyone = Window.partitionBy()
    labelled_n = F.sum(F.when(known, F.col("customers"))).over(everyone)
    return (
        groups.withColumn("customers_pct", percent(F.col("customers"), labelled_n, 1))
        .withColumn("gmv_pct", percent(F.col("gmv"), F.sum("gmv").over(everyone), 1))
        .where(known)
        .withColumn("ltv_median", ltv)
        .orderBy("churn_label")
    )


def churn_slice_averages(people: DataFrame) -> DataFrame:
    """Customers, average order count and amount per label of the customer table.

    Customers without a label are a group of their own.
    """
    groups = people.groupBy("churn_label").agg(
        F.count("*").alias("customers"),
        F.round(mean("orders"), 1).alias("purchases_avg"),
        F.sum("gmv").alias("amount"),
    )
    everyone = Window.partitionBy()
    return groups.select(
        "churn_label",
        "customers",
        "purchases_avg",
        F.round(F.col("amount").cast("double"), 0).alias("gmv"),
        percent(F.col("customers"), F.sum("customers").over(everyone), 1).alias("customers_pct"),
        percent(F.col("amount"), F.sum("amount").over(everyone), 1).alias("gmv_pct"),
    ).orderBy("churn_label")


def _summary(people: DataFrame, *more: Column) -> DataFrame:
    totals = people.agg(
        F.count("*").alias("customers"),
        _repeaters().alias("repeaters"),
        percent(_repeaters(), F.count("*"), 1).alias("repeat_pct"),
        F.sum("gmv").cast("double").alias("gmv_people"),
        F.min("gmv").cast("double").alias("ltv_min"),
        F.max("gmv").cast("double").alias("ltv_max"),
        *more,
    )
    return totals.withColumn("ltv_median", F.lit(ranks.median(people, "gmv")).cast("double"))


def _repeaters() -> Column:
    return F.count_if(F.col("orders") >= 2)
