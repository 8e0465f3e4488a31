"""Table readers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions import clean_id, to_margin, to_timestamp
from orderlens.plans.tables import typed_orders
from orderlens.sources import quoted

LABELS = {"churn_label", "fraud_label"}
DIMENSION_TEXT = {"country", "gender", "category"}
DIMENSION_NUMBERS = {"churn_label", "age", "loyalty_score", "lifetime_value", "popularity_score"}
# Words that stand for a missing value in the CSV inputs.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
ORDER_NUMBERS = ["discount_applied", "shipping_delay_days"]


@dataclass
class Inputs:
    """The input tables with typed columns; None for those that were not asked for."""

    transactions: DataFrame | None
    customers: DataFrame | None
    products: DataFrame | None
    behavior: DataFrame | None


ALL_INPUTS = frozenset({"transactions", "customers", "products", "behavior"})


def read_inputs(spark: SparkSession, folder: str, names: set[str] | frozenset[str] = ALL_INPUTS) -> Inputs:
    """The CSV inputs of a folder, typed; values that do not fit become null."""
    raw = {name: read_csv(spark, f"{folder}/{name}.csv") for name in ALL_INPUTS & names}

    def dimension(name: str, key: str) -> DataFrame | None:
        return typed_dimension(raw[name], key) if name in raw else None

    orders = None
    if "transactions" in raw:
        orders = typed_orders(raw["transactions"])
        numbers = {name: _number(name) for name in ORDER_NUMBERS if name in orders.columns}
        orders = orders.withColumns({**numbers, "fraud_label": _number("fraud_label")})
    return Inputs(
        orders,
        dimension("customers", "customer_id"),
        dimension("products", "product_id"),
        dimension("behavior", "customer_id"),
    )


def typed_dimension(df: DataFrame, key: str) -> DataFrame:
    """Key as trimmed text, dates as timestamps, known numbers as numbers.

    Any other column becomes a number if all of its values are numbers, which one pass
    over the table decides, and stays as text otherwise.
    """
    columns, open_ = {}, []
    for name in df.columns:
        if name == key:
            columns[name] = clean_id(name)
        elif name == "margin_percentage":
            columns[name] = to_margin(name)
        elif name.endswith("_date"):
            columns[name] = to_timestamp(name)
        elif name in DIMENSION_NUMBERS:
            columns[name] = _number(name)
        elif name not in DIMENSION_TEXT:
            open_.append(name)
    columns |= {name: _number(name) for name in numeric_columns(df, open_)}
    return df.withColumns(columns)


def numeric_columns(df: DataFrame, names: list[str]) -> list[str]:
    """Those of the columns whose values, one at least, are all numbers."""
    texts = [name for name in names if dict(df.dtypes)[name] == "string"]
    if not texts:
        return names
    checks = []
    for i, name in enumerate(texts):
        checks.append(F.count(F.col(f"`{name}`")).alias(f"n{i}"))
        checks.append(F.count(F.col(f"`{name}`").try_cast("double")).alias(f"m{i}"))
    row = df.agg(*checks).first()
    words = {name for i, name in enumerate(texts) if row[f"m{i}"] < max(row[f"n{i}"], 1)}
    return [name for name in names if name not in words]


def _number(name: str) -> Column:
    value = F.col(name).try_cast("double")
    return value.try_cast("int") if name in LABELS else value


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line as text columns, header names trimmed, missing values null.

    A quote inside a quoted field is doubled. Fields may hold line feeds: if a first pass finds a line that leaves a
    quote open, the records are put together from their lines, still by many tasks a file. There is no type
    inference; ``typed_orders`` and the feature tables coerce the values, bad ones to null.
    """
    lines = quoted.lines_of(spark, path)
    if quoted.has_open_lines(lines):
        df = quoted.table(lines)
    else:
        df = spark.read.option("header", True).option("escape", '"').csv(path)
    names = [name.strip() for name in df.columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"{path} repeats columns: {', '.join(repeated)}")
    df = df.toDF(*names)
    known = {c: F.when(~F.col(f"`{c}`").isin(MISSING), F.col(f"`{c}`")) for c in names}
    return df.withColumns(known)


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The saved order table and customer table."""
    return read_parquet(spark, latest(spark, folder, "clean")), read_people(spark, folder)


def read_people(spark: SparkSession, folder: str) -> DataFrame:
    return read_parquet(spark, latest_people(spark, folder))


def latest_people(spark: SparkSession, folder: str) -> str:
    return latest(spark, folder, "people")


def latest(spark: SparkSession, folder: str, name: str) -> str:
    """Path of the newest complete version of a saved table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    versions = [
        entry.getPath()
        for entry in (files.listStatus(path) if files.exists(path) else [])
        if files.exists(spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS"))
    ]
    if not versions:
        raise FileNotFoundError(f"no saved table {name} in {folder}")
    return max(versions, key=lambda p: p.getName()).toString()
