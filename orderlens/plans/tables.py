"""The denormalised order table and the one-row-per-customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import clean_id, money_sum, to_money, to_timestamp
from orderlens.operators.lookup import lookup_joins


def typed_orders(raw: DataFrame) -> DataFrame:
    """Ids trimmed, amounts exact decimals, dates timestamps; unreadable is null.

    No row is dropped. Other columns pass through.
    """
    readers = {
        "transaction_id": clean_id("transaction_id"),
        "customer_id": clean_id("customer_id"),
        "product_id": clean_id("product_id"),
        "order_value": to_money("order_value"),
        "order_date": to_timestamp("order_date"),
    }
    return raw.withColumns({k: v for k, v in readers.items() if k in raw.columns})


def add_order_key(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_key", F.col("transaction_id").cast("string"))


def with_clean_key(dim: DataFrame, key: str) -> DataFrame:
    return dim.withColumn(key, clean_id(key))


def clean_orders(
    orders: DataFrame,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    behavior: DataFrame | None = None,
) -> DataFrame:
    """Keyed orders with the columns of the dimensions given.

    A dimension without repeated keys adds columns only, so a report may leave out
    the dimensions it does not use.
    """
    out = orders if "order_key" in orders.columns else add_order_key(orders)
    given = ((customers, "customer_id"), (products, "product_id"), (behavior, "customer_id"))
    dims = [(with_clean_key(dim, key), key) for dim, key in given if dim is not None]
    return lookup_joins(out, dims, ["transaction_id", "order_value"])


def build_people(clean: DataFrame) -> DataFrame:
    """One row per customer: amount, distinct orders, first and last order.

    Rows without a customer are left out.
    """
    return (
        clean.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            money_sum().alias("gmv"),
            F.count_distinct("transaction_id").alias("orders"),
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
        )
    )


def customer_churn(clean: DataFrame) -> DataFrame:
    """Each customer's first known churn label by order date.

    Orders collapse to one row per customer and label before the shuffle. Labels
    that start at the same time are ordered by value.
    """
    known = clean.where(F.col("customer_id").isNotNull() & F.col("churn_label").isNotNull())
    starts = known.groupBy("customer_id", "churn_label").agg(F.min("order_date").alias("start"))
    order = F.struct(F.col("start").isNull(), "start", "churn_label")
    return starts.groupBy("customer_id").agg(F.min_by("churn_label", order).alias("churn_label"))
