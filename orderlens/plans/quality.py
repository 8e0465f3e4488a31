"""Checks on grain, keys, joins and totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions import money_sum, percent, profit_sum
from orderlens.operators import ranks
from orderlens.operators.storage import store
from orderlens.plans.sales import distinct_n


def grain(df: DataFrame) -> DataFrame:
    """'line' if rows outnumber distinct transactions by more than a fifth, else 'order'."""
    counted = df.agg(
        F.count("*").alias("rows_n"), F.count_distinct("transaction_id").alias("orders_n")
    )
    is_line = F.col("rows_n") > F.col("orders_n") * F.lit(1.2)
    return counted.withColumn("grain", F.when(is_line, "line").otherwise("order"))


def sanity(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows and orders before and after cleaning, money and date range, copies.

    Each distinct count is its own aggregate over one column; together in one they
    would repeat every row once per count.
    """
    totals = clean.agg(
        F.count("*").alias("rows_clean"),
        money_sum().cast("double").alias("gmv"),
        F.min("order_value").cast("double").alias("money_min"),
        F.max("order_value").cast("double").alias("money_max"),
        F.min("order_date").alias("date_min"),
        F.max("order_date").alias("date_max"),
        F.count_if(F.col("customer_id").isNull()).alias("missing_customers"),
    )
    counts = totals.select(
        "*",
        raw.agg(F.count("*")).scalar().alias("rows_raw"),
        distinct_n(raw, "transaction_id").alias("orders_raw"),
        distinct_n(clean, "transaction_id").alias("orders_clean"),
        distinct_n(clean, "customer_id").alias("customers_n"),
        distinct_n(clean, "product_id").alias("products_n"),
        duplicate_rows(clean).select("duplicate_rows").scalar().alias("duplicate_rows"),
        F.lit(ranks.median(clean, "order_value")).cast("double").alias("money_median"),
    )
    kept = percent(F.col("rows_raw") - F.col("rows_clean"), F.col("rows_raw"), 2)
    return counts.withColumn("dropped_pct", kept)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical row.

    Only 128-bit digests of the rows are shuffled. Rows whose digest occurs again are compared in full.
    """
    names = [F.col(f"`{c}`") for c in df.columns]
    first, second = F.xxhash64(*names), F.xxhash64(F.lit(1), *names)
    digests = df.select(first.alias("first"), second.alias("second")).groupBy("first", "second")
    counts = store(digests.agg(F.count("*").alias("n")), "digests")
    again = counts.where("n > 1").select(F.col("first").alias("again_first"), F.col("second").alias("again_second"))
    suspects = df.join(again, (first == F.col("again_first")) & (second == F.col("again_second")), "left_semi")
    copies = suspects.groupBy(*names).agg(F.count("*").alias("copies"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_n")).withColumn(
        "duplicate_rows", copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))).scalar()
    )


def bad_orders(clean: DataFrame, by_day: bool = False) -> DataFrame:
    """Orders with more than one customer, or more than one date.

    Two distinct values exist where the smallest is not the largest, which needs no
    distinct count.
    """
    date = F.to_date("order_date") if by_day else F.col("order_date")
    orders = clean.where(F.col("order_key").isNotNull()).groupBy("order_key").agg(
        F.min("customer_id").alias("customer_a"),
        F.max("customer_id").alias("customer_b"),
        F.min(date).alias("date_a"),
        F.max(date).alias("date_b"),
    )
    mixed = (F.col("customer_a") != F.col("customer_b")) | (F.col("date_a") != F.col("date_b"))
    return orders.agg(F.count_if(mixed).alias("bad_orders"))


def mixed_labels(clean: DataFrame, label: str = "churn_label") -> DataFrame:
    """Customers with more than one distinct label."""
    spans = clean.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min(label).alias("low"), F.max(label).alias("high")
    )
    return spans.agg(F.count_if(F.col("low") != F.col("high")).alias("mixed_customers"))


def dim_duplicates(dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per dimension: rows, and rows whose key another row has too, but for the first."""
    parts = []
    for name, (dim, key) in dims.items():
        copies = dim.groupBy(key).agg(F.count("*").alias("n"))
        parts.append(
            copies.agg(
                F.lit(name).alias("dim"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows_n"),
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def orphan_keys(orders: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Order rows whose key a dimension lacks, per dimension.

    Both sides hold each key once, so a hot key reaches the join as one row.
    """
    parts = []
    for name, (dim, key) in dims.items():
        uses = orders.groupBy(key).agg(F.count("*").alias("n"))
        lost = uses.join(dim.select(key).distinct(), key, "left_anti")
        parts.append(
            lost.agg(
                F.lit(name).alias("dim"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def join_inflation(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and amount on both sides of the dimension joins."""
    first = before.agg(F.count("*").alias("rows_n"), money_sum().cast("double").alias("gmv"))
    second = after.agg(F.count("*").alias("rows_n"), money_sum().cast("double").alias("gmv"))
    return first.withColumn("stage", F.lit("before")).unionByName(
        second.withColumn("stage", F.lit("after"))
    )


def contract_check(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Rows that break a table's contract: nulls per required column, repeated keys.

    The first field of the schema is the key.
    """
    required = [f.name for f in schema.fields if not f.nullable]
    key = schema.fields[0].name
    nulls = df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in required))
    repeated = df.agg(F.count(key) - F.count_distinct(key)).scalar()
    rules = [(f"{name} is null", F.col(name)) for name in required]
    rules.append((f"{key} repeated", F.col("repeated")))
    pairs = F.array(*(F.struct(F.lit(n).alias("rule"), c.alias("rows_n")) for n, c in rules))
    return (
        nulls.withColumn("repeated", repeated)
        .select(F.inline(pairs))
        .withColumn("table", F.lit(table))
    )


def added_columns(df: DataFrame) -> list[str]:
    """Which of the dimension columns the reports rely on are present."""
    wanted = ["country", "category", "churn_label", "margin_percentage"]
    return [name for name in wanted if name in df.columns]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows_n"))


def order_totals(clean: DataFrame) -> DataFrame:
    """Orders, customers, amount, profit and date range."""
    totals = clean.agg(
        money_sum().cast("double").alias("gmv"),
        profit_sum().alias("profit"),
        F.min("order_date").alias("date_min"),
        F.max("order_date").alias("date_max"),
    )
    return totals.select(
        distinct_n(clean, "order_key").alias("orders_n"),
        "*",
        distinct_n(clean, "customer_id").alias("customers_n"),
    )


def people_totals(people: DataFrame) -> DataFrame:
    return people.agg(
        F.count("*").alias("people_n"), F.sum("gmv").cast("double").alias("gmv_people")
    )


def preview(df: DataFrame, columns: list[str], order_by: list[str], rows: int = 5) -> DataFrame:
    """The first rows by key; each task keeps no more than ``rows``."""
    return df.select(*columns).orderBy(*order_by).limit(rows)
