"""Every key with an SQL twin gives the same rows there; the rest give rows at all."""

from __future__ import annotations

import pytest
from comparison import connect, differences

from orderlens.operators import ranks
from registry.oracles import ORACLES
from registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

# Keys whose plans join dimensions, run again on the way for large dimensions.
JOINED = [
    "clean_orders",
    "clean_lines",
    "clean_behavior",
    "publish_orders",
    "preview_people",
    "join_inflation",
    "orphan_keys",
    "kpi_country_sql",
    "kpi_category_sql",
    "churn_slice",
    "fraud_features",
]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {
        *(f"{m}_{k}" for m in ("churn", "fraud") for k in ("forest", "importance")),
    }


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", JOINED)
def test_same_without_broadcast(no_broadcast, con, name):
    assert differences(QUERIES[name](no_broadcast, FOLDER), con, ORACLES[name]) == []


RANKED = [
    "sanity_check",
    "people_rfm",
    "publish_people",
    "sql_views",
    "kpi_totals",
    "people_summary",
    "kpi_repeat",
    "kpi_medians_sql",
    "churn_slice",
    "rfm_customers",
    "rfm_segments",
    "rfm_champions",
    "rfm_by_recency",
    "rfm_sql_customers",
    "rfm_sql_segments",
    "rfm_sql_champions",
    "bi_customers",
]


@pytest.mark.parametrize("name", RANKED)
def test_ranks_take_rounds(spark, monkeypatch, name):
    """The registered queries run the distributed rounds, not one window over all rows."""
    rounds, split = [], ranks._split
    monkeypatch.setattr(ranks, "_split", lambda *a, **k: rounds.append(1) or split(*a, **k))
    QUERIES[name](spark, FOLDER)
    assert rounds


def test_column_types_match(spark, con):
    """Integer columns are integers on both sides, doubles doubles."""
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    for name in ("kpi_country", "rfm_customers", "people", "txn_features", "fraud_by_payment"):
        described = con.execute(f"DESCRIBE {ORACLES[name]}").fetchall()
        theirs = {row[0]: row[1] for row in described}
        ours = dict(QUERIES[name](spark, FOLDER).dtypes)
        assert {k: kinds.get(v, v) for k, v in ours.items() if v in kinds} == {
            k: theirs[k] for k, v in ours.items() if v in kinds
        }, name


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["country", "gmv", "orders", "aov"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
