"""Sales, customer, cohort, RFM, product and fraud reports on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.operators.storage import store
from orderlens.plans import customers, dashboard, products, retention, rfm, risk, sales, tables


@pytest.fixture
def clean(orders_of, spark):
    """Customer c has no label, order 5 no country and no margin."""
    rows = [
        ("1", "a", "2024-01-10", "100.00"),
        ("2", "a", "2024-02-10", "50.00"),
        ("3", "b", "2024-01-20 23:00:00", "10.00"),
        ("4", "c", "2024-02-25", "30.00"),
        ("5", "b", "2024-04-01 01:00:00", "10.00"),
    ]
    extra = spark.createDataFrame(
        [
            ("1", 0, "FR", "x", "p", 10.0, 1, "card"),
            ("2", 0, "FR", "x", "p", 10.0, 0, "card"),
            ("3", 1, "BR", "y", "q", 20.0, 0, "cash"),
            ("4", None, "BR", "y", "q", 20.0, 0, None),
            ("5", 1, None, None, "r", None, 1, "cash"),
        ],
        "transaction_id string, churn_label int, country string, category string,"
        " product_id string, margin_percentage double, fraud_label int, payment_method string",
    )
    return orders_of(rows).join(extra, "transaction_id")


@pytest.fixture
def people(clean):
    return tables.build_people(clean)


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_sales(clean):
    total = sales.totals_with_spread(clean).first()
    assert (total["gmv"], total["orders"], total["aov"], total["money_median"]) == (200.0, 5, 40.0, 30.0)
    kept = sales.by_dimension(clean, "country")
    assert rows(kept, "country", "gmv", "orders", "aov") == [("FR", 150.0, 2, 75.0), ("BR", 40.0, 2, 20.0)]
    assert rows(sales.by_dimension(clean, "country", keep_null=True), "country") == [("FR",), ("BR",), (None,)]
    assert rows(sales.by_year_month(clean), "year", "month", "gmv") == [
        (2024, 1, 110.0),
        (2024, 2, 80.0),
        (2024, 4, 10.0),
    ]


def test_empty_input_gives_null_ratio(clean):
    none = clean.where("1 = 0")
    assert rows(sales.totals_with_spread(none), "gmv", "orders", "aov", "money_median") == [(None, 0, None, None)]
    assert dashboard.sales_measures(none).first()["margin"] is None
    people = tables.build_people(none)
    assert rows(customers.repeat_report(people), "customers", "repeat_pct", "ltv_median") == [(0, None, None)]
    assert rfm.score_by_quantiles(none, people).count() == 0
    assert rfm.score_by_tiles(none, people).count() == 0
    assert retention.retention_matrix(none).count() == 0


def test_repeat_and_medians(people):
    report = customers.repeat_report(people).first()
    assert (report["customers"], report["repeaters"], report["repeat_pct"]) == (3, 2, 66.7)
    assert (report["purchases_median"], report["ltv_median"]) == (2.0, 30.0)
    lower = dict(rows(customers.lower_medians(people.where("customer_id <> 'c'")), "metric", "median_value"))
    assert lower == {"purchases": 2.0, "ltv": 20.0}


def test_churn_slices_differ_on_missing_labels(clean, people):
    found = rows(
        customers.churn_slice(clean, people),
        "churn_label", "customers", "customers_pct", "gmv_pct", "ltv_median", "purchases_median",
    )
    assert found == [(0, 1, 50.0, 75.0, 150.0, 2.0), (1, 1, 50.0, 10.0, 20.0, 2.0)]
    labelled = people.join(tables.customer_churn(clean), "customer_id", "left")
    assert rows(customers.churn_slice_averages(labelled), "churn_label", "customers_pct", "gmv_pct") == [
        (None, 33.3, 15.0),
        (0, 33.3, 75.0),
        (1, 33.3, 10.0),
    ]


def test_retention(clean, people):
    jan, feb = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    found = rows(retention.retention_long(clean), "cohort", "period_n", "active_n", "cohort_size", "retention")
    assert found == [(jan, 0, 2, 2, 1.0), (jan, 1, 1, 2, 0.5), (jan, 3, 1, 2, 0.5), (feb, 0, 1, 1, 1.0)]
    wide = retention.retention_matrix(clean).collect()
    assert [r["period_1"] for r in wide] == [0.5, 0.0] and wide[0]["period_2"] == 0.0
    full = retention.retention_full(clean).collect()
    assert {(r["cohort"], r["period_n"]): r["retention"] for r in full} == {
        (c, p): v for c, vs in ((jan, (1.0, 0.5, 0.5)), (feb, (1.0, 0.0, 0.0))) for p, v in zip((0, 1, 3), vs)
    }
    assert retention.first_period_median(clean).first()[0] == 0.25
    assert retention.first_period_median(clean.where("order_key IN ('1', '3')")).first()[0] is None
    assert rows(retention.cohort_summary(clean), "cohorts", "size_min", "size_median", "size_max") == [(2, 1, 1.5, 2)]
    assert rows(retention.cohort_summary_of_people(people), "cohorts_n", "size_min", "size_max") == [(2, 1, 2)]


def test_calendars_of_many_years(orders_of):
    """Months around the ends of words, the last bits included; a stored calendar stands for the orders."""
    days = {"a": ["1959-12-31", "1960-01-01", "1964-12-31", "1965-01-01", "2024-12-05"], "b": ["1964-12-01"], "c": ["1969-12-09", "1960-01-31"]}
    table = [(f"{c}{k}", c, day, "1") for c, own in days.items() for k, day in enumerate(own)]
    table += [(f"x{k}", "a", "2024-12-06", "1") for k in range(50)] + [("n", None, "2024-01-01", "1"), ("o", "d", None, "1")]
    clean = orders_of(table)
    stored = store(retention.calendars(clean), "calendars")
    months = {c: sorted({(int(d[:4]), int(d[5:7])) for d in own}) for c, own in days.items()}
    want = {
        (c, dt.date(*own[0], 1), dt.date(y, m, 1), (y - own[0][0]) * 12 + m - own[0][1])
        for c, own in months.items()
        for y, m in own
    }
    for source in (clean, stored):
        found = rows(retention.active_months(source), "customer_id", "cohort", "order_month", "period_n")
        assert len(found) == len(want) and set(found) == want
    for report in (retention.customer_cohorts, retention.cohort_sizes, retention.cohort_activity, retention.retention_full):
        assert sorted(map(str, report(stored).collect())) == sorted(map(str, report(clean).collect()))
    assert retention.first_period_median(stored).first() == retention.first_period_median(clean).first()


def test_young_cohorts_can_be_left_out(orders_of):
    clean = orders_of(
        [("1", "a", "2024-01-01", "1"), ("2", "a", "2024-02-01", "1"), ("3", "b", "2024-02-01", "1")]
    )
    assert retention.first_period_median(clean).first()[0] == 0.5
    assert retention.first_period_median(clean, observed_only=True).first()[0] == 1.0


def test_order_split_over_months_counts_once(orders_of):
    clean = orders_of([("1", "a", "2024-01-31", "1"), ("1", "a", "2024-02-01", "1")])
    assert rows(retention.cohort_activity(clean), "period_n", "active_n") == [(0, 1)]


def test_recency_counts_completed_days(orders_of):
    clean = orders_of([("1", "a", "2024-01-01 23:00:00", "1"), ("2", "b", "2024-01-02 01:00:00", "1")])
    scored = rfm.score_by_quantiles(clean, tables.build_people(clean))
    assert dict(rows(scored, "customer_id", "recency")) == {"a": 0, "b": 0}


def test_rfm_definitions_differ_on_equal_recency(orders_of):
    ids = ["10", "9", "8", "7", "6"]
    clean = orders_of([(f"t{i}", i, "2024-01-01", "5") for i in ids])
    people = tables.build_people(clean)
    by_value = rfm.score_by_quantiles(clean, people)
    assert {r["r_score"] for r in by_value.collect()} == {3}
    tiles = dict(rows(rfm.score_by_tiles(clean, people), "customer_id", "r_score"))
    assert tiles == {"10": 3, "6": 3, "7": 2, "8": 2, "9": 1}
    frequency = dict(rows(by_value, "customer_id", "f_score"))
    assert frequency == {"10": 1, "6": 1, "7": 2, "8": 3, "9": 3}
    assert rows(rfm.segment_sizes(by_value), "segment", "customers") == [("311", 2), ("333", 2), ("322", 1)]
    top = rfm.champions_and_cold(by_value).first()
    assert (top["champions"], top["champions_gmv_pct"], top["cold"], top["cold_pct"]) == (2, 40.0, 0, 0.0)


def test_rfm_without_last_order_column(clean, people):
    with_column = rfm.score_by_quantiles(clean, people)
    without = rfm.score_by_quantiles(clean, people.drop("last_order"))
    assert sorted(map(tuple, with_column.collect())) == sorted(map(tuple, without.collect()))


def test_segment_counts_add_up(spark):
    from orderlens.sources.star import StarTables

    star = StarTables(spark, "/root/testdata/sf0.001")
    orders = tables.add_order_key(star.transactions())
    people = tables.build_people(orders)
    scored = rfm.score_by_quantiles(orders, people)
    assert scored.count() == people.count()
    assert rfm.segment_sizes(scored, 27).agg(F.sum("customers")).first()[0] == people.count()
    total = orders.agg(F.sum("order_value")).first()[0]
    assert people.agg(F.sum("gmv")).first()[0] == total
    active = retention.sized_activity(orders).where("period_n = 0")
    assert active.where("active_n <> cohort_size").count() == 0


def test_products(clean):
    margin = products.margin(clean).first()
    assert (margin["sku"], margin["gmv"], margin["profit"], margin["margin_pct"]) == (3, 200.0, 23.0, 11.5)
    assert rows(products.by_product(clean), "product_id", "profit", "aov", "margin_pct") == [
        ("p", 15.0, 75.0, 10.0),
        ("q", 8.0, 20.0, 20.0),
        ("r", None, 10.0, None),
    ]
    assert rows(products.top_products(clean, 1), "product_id") == [("p",)]
    assert rows(products.by_category(clean), "category") == [("x",), ("y",)]
    assert rows(products.by_category_with_null(clean), "category", "margin_pct") == [
        ("x", 10.0),
        ("y", 20.0),
        (None, None),
    ]


def test_fraud(clean):
    overall = risk.fraud_overall(clean).first()
    assert (overall["fraud_pct"], overall["fraud_rows"], overall["rows_n"]) == (40.0, 2, 5)
    found = rows(risk.fraud_by(clean, "payment_method"), "payment_method", "orders", "fraud_n", "fraud_pct")
    assert found == [("card", 2, 1, 50.0), ("cash", 2, 1, 50.0)]
    assert dashboard.fraud_measure(clean).first()[0] == 0.4


def test_dashboard(clean, people):
    row = dashboard.sales_measures(clean).first()
    assert (row["gmv"], row["profit_total"], row["margin"]) == (200.0, 23.0, 0.115)
    row = dashboard.customer_measures(people).first()
    assert (row["customers"], row["ltv_median"]) == (3, 30.0)
    assert row["repeat_share"] == pytest.approx(2 / 3)
