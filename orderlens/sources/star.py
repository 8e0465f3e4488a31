"""The four input tables expressed over TPC-H-like star tables.

All rows of all tables are used. Some orders refer to customers and products that do
not exist, so that orphans and null groups occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.lookup import lookup_join
from orderlens.schemas import MARGIN, MONEY

TABLES = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
    " l_extendedprice double, l_shipdate timestamp_ntz",
    "customer": "c_custkey long, c_nationkey int, c_acctbal double",
    "part": "p_partkey long, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string",
    "events": "user_id long, ts timestamp_ntz, event_type string, value double",
}


class StarTables:
    """Inputs of the analytics read from the parquet files in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def order_customer(self) -> Column:
        """The customer; an unknown one in every 47th order."""
        unknown = F.when(F.col("o_orderkey") % 47 == 0, -F.col("o_custkey"))
        return F.coalesce(unknown, F.col("o_custkey")).cast("string")

    def order_product(self) -> Column:
        """Orders are dealt out over all products; every 40th order has an unknown one."""
        key = F.col("o_orderkey")
        last = self.table("part").agg(F.max("p_partkey")).scalar()
        product = key % last + 1
        return F.when(key % 40 == 39, -product).otherwise(product).cast("string")

    def transactions(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.table("orders").select(
            key.cast("string").alias("transaction_id"),
            self.order_customer().alias("customer_id"),
            self.order_product().alias("product_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_totalprice").cast(MONEY).alias("order_value"),
            F.when(key % 23 == 0, 1).otherwise(0).alias("fraud_label"),
            F.col("o_orderpriority").alias("payment_method"),
            F.col("o_orderstatus").alias("device_type"),
            ((key % 11).cast("decimal(8,2)") / 100).cast("decimal(8,4)").alias("discount_applied"),
            (key % 8).cast("int").alias("shipping_delay_days"),
        )

    def text_transactions(self) -> DataFrame:
        """The order columns as padded text, some amounts and dates unreadable.

        Dates come in four formats, some amounts have three places, and a note has
        quotes, a comma, in every third order a line feed, and sometimes a word for a missing value.
        """
        key = F.col("o_orderkey")
        amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
        amount = F.when(key % 5 == 0, F.concat(amount, F.lit("5"))).otherwise(amount)
        date = F.date_format("o_orderdate", "MM/dd/yyyy")
        for rest, form in ((1, "MMM d yyyy"), (2, "yyyyMMdd"), (3, "MM/dd/yy")):
            date = F.when(key % 4 == rest, F.date_format("o_orderdate", form)).otherwise(date)
        gap = F.when(key % 3 == 0, F.lit("\n")).otherwise(F.lit(" "))
        note = F.concat(F.lit('say "hi",'), gap, F.lit("order "), (key % 7).cast("string"))
        return self.table("orders").select(
            F.concat(F.lit("\t "), key.cast("string"), F.lit("\u00a0")).alias("transaction_id"),
            F.concat(F.lit("\u00a0"), self.order_customer()).alias("customer_id"),
            F.concat(self.order_product(), F.lit("  ")).alias("product_id"),
            F.when(key % 89 == 0, F.lit("13/45/1996")).otherwise(date).alias("order_date"),
            F.when(key % 97 == 0, F.lit("n/a")).otherwise(amount).alias("order_value"),
            F.when(key % 31 == 0, F.lit("NA")).otherwise(note).alias("note"),
        )

    def order_lines(self) -> DataFrame:
        """Line grain, keyed by order, without the order's own columns; every 40th order's
        lines have unknown products."""
        unknown = F.when(F.col("l_orderkey") % 40 == 39, -F.col("l_partkey"))
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("transaction_id"),
            F.col("l_orderkey").cast("string").alias("order_key"),
            F.coalesce(unknown, F.col("l_partkey")).cast("string").alias("product_id"),
            F.col("l_extendedprice").cast(MONEY).alias("order_value"),
        )

    def dated_lines(self) -> DataFrame:
        """Line grain with customer and date of the order."""
        header = self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("order_key"),
            self.order_customer().alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
        )
        return lookup_join(
            self.order_lines(), header, "order_key", ["product_id", "order_value"], "inner"
        )

    def shipments(self) -> DataFrame:
        """Lines seen as orders of their supplier, dated by shipping."""
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_key"),
            F.col("l_suppkey").cast("string").alias("customer_id"),
            F.col("l_shipdate").alias("order_date"),
        )

    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        joined = lookup_join(
            self.table("customer").withColumnRenamed("c_nationkey", "nation"),
            self.table("nation").withColumnRenamed("n_nationkey", "nation"),
            "nation",
            ["c_custkey"],
            "inner",
        )
        start = F.lit("1994-01-01").cast("timestamp_ntz")
        days = F.make_dt_interval((key % 365).cast("int"))
        return joined.select(
            key.cast("string").alias("customer_id"),
            F.col("n_name").alias("country"),
            F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("churn_label"),
            (18 + key % 60).cast("int").alias("age"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            F.col("c_acctbal").alias("loyalty_score"),
            (start + days).alias("registration_date"),
            (F.col("c_acctbal") * 2).alias("lifetime_value"),
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.split_part("p_type", F.lit(" "), F.lit(1)).alias("category"),
            F.col("p_size").cast(MARGIN).alias("margin_percentage"),
            F.col("p_retailprice").alias("popularity_score"),
        )

    def behavior(self) -> DataFrame:
        kinds = {
            "views": "view",
            "clicks": "click",
            "purchases": "purchase",
            "errors": "error",
            "signups": "signup",
        }
        counts = [F.count_if(F.col("event_type") == v).alias(k) for k, v in kinds.items()]
        total = F.sum(F.col("value").cast("decimal(18,6)")).cast("double")
        return (
            self.table("events")
            .groupBy(F.col("user_id").cast("string").alias("customer_id"))
            .agg(
                *counts,
                (total / F.count("value")).alias("avg_event_value"),
                (F.count_if(F.col("event_type") == "error") / F.count("*")).alias(
                    "behavior_churn_signal"
                ),
            )
        )
