"""Column contracts of the tables the package reads and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Six places are kept; the product of an amount and a margin still fits in 38 digits.
MONEY = T.DecimalType(24, 6)
MARGIN = T.DecimalType(12, 6)

# The columns of the two published tables. Profit is added to the orders,
# the churn label to the customers.
ORDER_COLUMNS = [
    "transaction_id",
    "order_key",
    "customer_id",
    "product_id",
    "order_date",
    "order_value",
    "country",
    "category",
    "margin_percentage",
    "churn_label",
    "fraud_label",
    "payment_method",
    "device_type",
]

PEOPLE_COLUMNS = ["customer_id", "gmv", "orders", "first_order", "segment", "R"]

CLEAN_ORDERS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("order_key", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("product_id", T.StringType()),
        T.StructField("order_date", T.TimestampNTZType(), False),
        T.StructField("order_value", MONEY, False),
        T.StructField("profit", T.DoubleType()),
        T.StructField("country", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("margin_percentage", MARGIN),
        T.StructField("churn_label", T.IntegerType()),
        T.StructField("fraud_label", T.IntegerType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("device_type", T.StringType()),
    ]
)

PEOPLE = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("gmv", T.DecimalType(34, 6), False),
        T.StructField("orders", T.LongType(), False),
        T.StructField("first_order", T.TimestampNTZType(), False),
        T.StructField("churn_label", T.IntegerType()),
        T.StructField("segment", T.StringType()),
        T.StructField("R", T.IntegerType()),
    ]
)


def require_columns(df: DataFrame, names: list[str], table: str) -> DataFrame:
    """Return ``df`` unchanged, or raise naming every column it lacks."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks columns: {', '.join(missing)}")
    return df


def present_columns(df: DataFrame, names: list[str]) -> list[str]:
    """The subset of ``names`` that ``df`` has, in the order given."""
    return [name for name in names if name in df.columns]
