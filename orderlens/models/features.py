"""Feature tables for the churn model (per customer) and the fraud model (per order)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions import days_from, mean, money_sum, percent, ratio, to_timestamp
from orderlens.operators.lookup import lookup_joins

LABEL = "label"
MISSING_LEVEL = "(missing)"

# Which columns are categories, features, or kept out of the features.
CHURN_CATEGORIES = ["gender", "country"]
FRAUD_CATEGORIES = ["payment_method", "device_type", "gender", "country", "category"]

# Order features a customer without orders gets as 0, recency included.
ORDER_FEATURES = [
    "orders_n",
    "gmv",
    "aov",
    "avg_discount",
    "avg_ship_delay",
    "fraud_rate",
    "recency_days",
    "tenure_days",
]
CHURN_EXCLUDED = ["churn_label", "behavior_churn_signal", "lifetime_value", "registration_date"]
FRAUD_CUSTOMER = ["customer_id", "age", "gender", "country", "loyalty_score"]
FRAUD_PRODUCT = ["product_id", "category", "margin_percentage", "popularity_score"]
FRAUD_EXCLUDED = [
    "fraud_label",
    "customer_id",
    "product_id",
    "order_date",
    "churn_label",
    "lifetime_value",
    "registration_date",
]


def order_features(transactions: DataFrame) -> DataFrame:
    """Per customer: counts, amount, averages, days since and between orders."""
    known = transactions.where(F.col("customer_id").isNotNull())
    grouped = known.groupBy("customer_id").agg(
        F.count_distinct("transaction_id").alias("orders_n"),
        money_sum().cast("double").alias("gmv"),
        mean("discount_applied").alias("avg_discount"),
        mean("shipping_delay_days").alias("avg_ship_delay"),
        mean("fraud_label").alias("fraud_rate"),
        F.max("order_date").alias("last_order"),
        F.min("order_date").alias("first_order"),
    )
    return grouped.select(
        "customer_id",
        "orders_n",
        "gmv",
        "avg_discount",
        "avg_ship_delay",
        "fraud_rate",
        ratio(F.col("gmv"), F.col("orders_n")).alias("aov"),
        days_from(F.col("last_order"), latest_order(transactions)).alias("recency_days"),
        days_from(F.col("first_order"), F.col("last_order")).alias("tenure_days"),
    )


def latest_order(transactions: DataFrame) -> Column:
    """Date of the last order as a scalar subquery."""
    return transactions.agg(F.max("order_date")).scalar()


def churn_features(
    customers: DataFrame, behavior: DataFrame, transactions: DataFrame
) -> DataFrame:
    """One row per customer: id, label and features.

    All three inputs hold a customer once, so the joins meet no hot key.
    """
    joined = customers.join(behavior, "customer_id", "left").join(
        order_features(transactions), "customer_id", "left"
    )
    registered = to_timestamp("registration_date")
    tenure = days_from(registered, latest_order(transactions))
    return (
        joined.withColumn("reg_tenure_days", tenure)
        .withColumn(LABEL, F.col("churn_label").cast("int"))
        .drop(*CHURN_EXCLUDED)
        .fillna(0, subset=ORDER_FEATURES)
    )


def fraud_features(
    transactions: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """One row per order: id, label and features."""
    spread = ["transaction_id", "order_value"]
    dims = [
        (customers.select(*FRAUD_CUSTOMER), "customer_id"),
        (products.select(*FRAUD_PRODUCT), "product_id"),
    ]
    joined = lookup_joins(transactions, dims, spread)
    return joined.withColumn(LABEL, F.col("fraud_label").cast("int")).drop(*FRAUD_EXCLUDED)


def column_kinds(
    features: DataFrame, id_column: str, categories: list[str]
) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature names. Text that is not listed is no feature."""
    listed = [name for name in categories if name in features.columns]
    texts = {f.name for f in features.schema.fields if isinstance(f.dataType, T.StringType)}
    left_out = {*listed, *texts, id_column, LABEL}
    return [c for c in features.columns if c not in left_out], listed


def numeric(features: DataFrame, names: list[str]) -> DataFrame:
    """Numeric features as doubles."""
    return features.withColumns({name: F.col(name).cast("double") for name in names})


def with_missing_level(features: DataFrame, names: list[str]) -> DataFrame:
    """A missing category is a level of its own."""
    return features.fillna(MISSING_LEVEL, subset=names) if names else features


def label_share(df: DataFrame, label: str, digits: int) -> DataFrame:
    """Rows and percentage of label 1."""
    return df.agg(
        F.count("*").alias("rows_n"),
        percent(F.sum(label), F.count(label), digits).alias("label_pct"),
    )
