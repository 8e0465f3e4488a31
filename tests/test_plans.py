"""Physical plans: what is read, shuffled, and gathered."""

from __future__ import annotations

import re

import pytest

from orderlens.operators import storage
from registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_reads_only_the_columns_used(spark):
    schema = re.search(r"ReadSchema: (\S+)", plan(spark, "fraud_overall")).group(1)
    assert schema == "struct<o_orderkey:bigint>"


@pytest.mark.parametrize("name", ["rfm_customers", "rfm_sql_customers", "people_rfm", "people", "customer_cohort", "customer_churn", "txn_features"])
def test_nothing_large_is_gathered(spark, name):
    """One-row subqueries aside, no exchange goes to a single partition."""
    main = [line for line in plan(spark, name).splitlines() if "SinglePartition" in line]
    assert all(re.match(r"[\s:+\-|*()0-9]*Exchange SinglePartition", line) for line in main)
    assert all(line.index("Exchange") > 8 and ":" in line[:8] for line in main)


@pytest.mark.parametrize("name", ["kpi_country", "kpi_category", "fraud_by_payment", "kpi_year_month"])
def test_distinct_counts_shuffle_by_order(spark, name):
    assert re.search(r"Exchange hashpartitioning\([^)]*(order_key|transaction_id)[^)]*\)", plan(spark, name))


@pytest.mark.parametrize("name", ["cohort_active", "cohort_size", "retention_matrix"])
def test_customers_meet_as_calendars(spark, name):
    """Months are bits before customers meet; no window runs over a customer's rows."""
    text = plan(spark, name)
    assert "partial_bit_or" in text
    assert not re.search(r"Window \[[^\n]*customer_id", text)


def test_top_rows_are_kept_per_task(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_products")
    assert "TakeOrderedAndProject" in plan(spark, "preview_orders")


def test_scores_are_row_expressions(spark):
    text = plan(spark, "rfm_customers")
    assert "Window" not in text and "Exchange" not in text


def test_no_cross_join_and_no_python(spark):
    for name in ("kpi_totals", "sanity_check", "retention_full", "join_inflation", "churn_slice", "fraud_features"):
        text = plan(spark, name)
        assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|ArrowEval", text), name


def test_stored_results_need_a_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert storage.new_path(spark, "x").startswith(folder)
    stored = storage.store(spark.range(3).selectExpr("id", "cast(id as decimal(18,2)) d"))
    assert stored.dtypes == [("id", "bigint"), ("d", "decimal(18,2)")] and stored.count() == 3
