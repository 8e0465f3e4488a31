"""Typing, keys, tables and quality checks on hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens import functions as fn
from orderlens import schemas
from orderlens.plans import quality, tables
from orderlens.sources import readers


def test_csv_header_and_values_are_trimmed_and_typed(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        " transaction_id , customer_id , product_id,order_date,order_value\n"
        "  7 , 1 ,p1,2024-02-03 04:05:06,12.5\n"
        "8,,p2,3/4/2024,abc\n"
        "9,2,p3,2024-13-45,1e2\n"
    )
    raw = readers.read_csv(spark, str(tmp_path / "t.csv"))
    assert raw.columns == [
        "transaction_id", "customer_id", "product_id", "order_date", "order_value",
    ]
    rows = tables.typed_orders(raw).orderBy("product_id").collect()
    assert [r["transaction_id"] for r in rows] == ["7", "8", "9"]
    assert [r["customer_id"] for r in rows] == ["1", None, "2"]
    assert [r["order_value"] for r in rows] == [Decimal("12.50"), None, Decimal("100.00")]
    assert [r["order_date"] for r in rows] == [
        dt.datetime(2024, 2, 3, 4, 5, 6),
        dt.datetime(2024, 3, 4),
        None,
    ]


def test_repeated_header_names_are_refused(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a, a\n1,2\n")
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path / "t.csv"))


def test_days_are_completed_days(spark):
    rows = [
        ("2024-01-01 23:00:00", "2024-01-02 01:00:00", 0),
        ("2024-01-01 01:00:00", "2024-01-02 01:00:00", 1),
        ("2024-01-02 00:00:00", "2024-01-01 12:00:00", -1),
        ("2024-01-01 00:00:00", None, None),
    ]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    a, b = (F.col(c).cast("timestamp_ntz") for c in "ab")
    assert df.where(~fn.days_from(a, b).eqNullSafe(F.col("n"))).count() == 0


def test_months_and_ratios(spark):
    row = spark.sql(
        "SELECT date'2023-11-30' a, date'2024-02-01' b, 0L zero, 3L three, 200L n"
    ).select(
        fn.months_from(F.col("a"), F.col("b")).alias("months"),
        fn.ratio(F.col("three"), F.col("zero")).alias("none"),
        fn.percent(F.col("three"), F.col("n"), 1).alias("pct"),
    ).first()
    assert (row["months"], row["none"], row["pct"]) == (3, None, 1.5)


def test_people_leave_out_rows_without_customer(orders_of):
    clean = orders_of(
        [
            ("1", "a", "2024-01-01", "10.00"),
            ("1", "a", "2024-01-02", "5.00"),
            ("2", "a", "2024-03-01", None),
            ("3", None, "2024-01-01", "7.00"),
        ],
        product_id="p",
    )
    rows = tables.build_people(clean).collect()
    assert [(r["customer_id"], r["gmv"], r["orders"]) for r in rows] == [("a", Decimal("15.00"), 2)]
    assert rows[0]["first_order"] == dt.datetime(2024, 1, 1)
    checked = quality.sanity(clean, clean).first()
    assert (checked["missing_customers"], checked["gmv"], checked["orders_clean"]) == (1, 22.0, 3)


def test_grain_boundary(spark):
    def grain(ids):
        df = spark.createDataFrame([(i,) for i in ids], "transaction_id string")
        return quality.grain(df).first()["grain"]

    assert grain("abcde" "a") == "order"
    assert grain("abcde" "ab") == "line"


def test_repeated_dimension_key_inflates(spark, orders_of):
    orders = orders_of([("1", "a", "2024-01-01", "10.00")], product_id="p")
    products = spark.createDataFrame([("p", "x"), (" p ", "y")], "product_id string, category string")
    dims = {"products": (tables.with_clean_key(products, "product_id"), "product_id")}
    assert quality.dim_duplicates(dims).first()["duplicate_keys"] == 1
    joined = tables.clean_orders(orders, products=products)
    stages = {r["stage"]: (r["rows_n"], r["gmv"]) for r in quality.join_inflation(orders, joined).collect()}
    assert stages == {"before": (1, 10.0), "after": (2, 20.0)}


def test_dim_duplicates_count_null_keys(spark):
    dim = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    row = quality.dim_duplicates({"d": (dim, "k")}).first()
    assert (row["rows_n"], row["duplicate_keys"]) == (5, 2)


def test_orphans_count_rows_and_null_keys(spark, orders_of):
    orders = orders_of([(str(i), c, "2024-01-01", "1.00") for i, c in enumerate(["a", "a", "b", "x", "x", None])])
    dim = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "customer_id string")
    assert quality.orphan_keys(orders, {"c": (dim, "customer_id")}).first()["orphan_rows"] == 3


def test_bad_orders_by_time_and_by_day(orders_of):
    clean = orders_of(
        [
            ("1", "a", "2024-01-01 01:00:00", "1.00"),
            ("1", "a", "2024-01-01 02:00:00", "1.00"),
            ("2", "a", "2024-01-01", "1.00"),
            ("2", "b", "2024-01-01", "1.00"),
            ("3", "a", "2024-01-01", "1.00"),
            ("3", None, "2024-01-01", "1.00"),
        ]
    )
    assert quality.bad_orders(clean).first()[0] == 2
    assert quality.bad_orders(clean, by_day=True).first()[0] == 1


def test_duplicate_rows(orders_of):
    row = ("1", None, "2024-01-01", "1.00")
    checked = quality.duplicate_rows(orders_of([row, row, row, ("2", "a", None, "1.00")])).first()
    assert (checked["rows_n"], checked["duplicate_rows"]) == (4, 2)
    assert quality.duplicate_rows(orders_of([])).first()["duplicate_rows"] == 0


def test_duplicates_shuffle_digests(spark, tmp_path):
    """No text column goes through the exchange in which all rows are counted."""
    from orderlens.plans import quality

    path = str(tmp_path / "rows")
    spark.range(100).selectExpr("id", "repeat('x', 20) AS wide", "CAST(NULL AS string) AS none").write.parquet(path)
    seen = []
    store = quality.store
    try:
        quality.store = lambda df, label: seen.append(df) or store(df, label)
        row = quality.duplicate_rows(spark.read.parquet(path).unionByName(spark.read.parquet(path).where("id < 7"))).first()
    finally:
        quality.store = store
    assert (row["rows_n"], row["duplicate_rows"]) == (107, 7)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("\n") if "Exchange" in line]
    assert exchanges and not any("wide" in line or "id#" in line for line in exchanges)


def test_first_known_label(spark):
    rows = [
        ("a", None, "2024-01-01"),
        ("a", 1, "2024-01-02"),
        ("a", 0, "2024-01-03"),
        ("b", 0, "2024-01-01"),
        ("b", 1, "2024-01-01"),
        ("c", None, "2024-01-01"),
        ("d", 1, None),
        (None, 1, "2024-01-01"),
    ]
    df = spark.createDataFrame(rows, "customer_id string, churn_label int, d string")
    clean = df.withColumn("order_date", F.col("d").cast("timestamp_ntz"))
    labels = {r[0]: r[1] for r in tables.customer_churn(clean).collect()}
    assert labels == {"a": 1, "b": 0, "d": 1}
    assert quality.mixed_labels(clean).first()[0] == 2


def test_contract(orders_of):
    clean = orders_of([("1", "a", None, "1.00"), ("1", None, "2024-01-01", None)])
    found = {r["rule"]: r["rows_n"] for r in quality.contract_check(clean, schemas.CLEAN_ORDERS, "t").collect()}
    assert found == {
        "transaction_id is null": 0,
        "order_key is null": 0,
        "customer_id is null": 1,
        "order_date is null": 1,
        "order_value is null": 1,
        "transaction_id repeated": 1,
    }


def test_missing_columns_are_named(orders_of):
    with pytest.raises(ValueError, match="country, category"):
        schemas.require_columns(
            orders_of([]), ["order_key", "country", "category"], "the order table"
        )
    assert quality.added_columns(orders_of([], country="x")) == ["country"]
