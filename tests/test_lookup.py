"""Dimension joins with hot keys, null keys and repeated dimension keys."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderlens.operators import lookup


@pytest.fixture
def fact(spark):
    """A third of the rows on one key, a tenth without a key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None)
    return spark.range(6000).select(
        F.col("id").cast("string").alias("transaction_id"),
        key.otherwise((F.col("id") % 2000).cast("string")).alias("k"),
    )


@pytest.fixture
def dim(spark):
    rows = [("hot", "a"), ("hot", "b"), (None, "none")] + [(str(i), f"n{i}") for i in range(1500)]
    return spark.createDataFrame(rows, "k string, name string")


def bag(df):
    return Counter(tuple(r) for r in df.select("transaction_id", "k", "name").collect())


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(no_broadcast, fact, dim, how):
    joined = lookup.lookup_join(fact, dim, "k", ["transaction_id"], how)
    assert "_salt" in joined._jdf.queryExecution().executedPlan().toString()
    assert set(joined.columns) == {"transaction_id", "k", "name"}
    assert bag(joined) == bag(fact.join(dim, "k", how))


def test_small_dimension_is_broadcast(spark, fact, dim):
    joined = lookup.lookup_join(fact, dim, "k", ["transaction_id"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_salt" not in plan
    assert bag(joined) == bag(fact.join(dim, "k", "left"))


def test_size_is_measured(spark, dim):
    """A join multiplies the estimate; the measurement still finds the true size."""
    product = dim.join(dim.withColumnRenamed("name", "other"), "k")
    assert lookup.fits_broadcast(product)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "1KB")
        assert lookup.broadcast_limit(dim) == 1024
        assert not lookup.fits_broadcast(dim)
    finally:
        spark.conf.set(name, before)


def test_only_the_hot_key_is_found(fact):
    shares = lookup.hot_keys(fact.withColumn("other", F.lit(7)), ["k", "other"])
    assert list(shares["k"]) == ["hot"] and 0.25 < shares["k"]["hot"] < 0.4
    assert shares["other"] == {"7": 1.0}
    assert lookup.hot_keys(fact.where(F.col("k").isNull()), ["k"]) == {"k": {}}


def test_parts_grow_with_the_share():
    shares = {"third": 1 / 3, "tenth": 0.1, **{f"k{i}": 0.001 for i in range(500)}}
    parts = lookup.spread_parts(shares, 1000)
    assert (parts["third"], parts["tenth"], parts["k7"]) == (1024, 256, 2)
    assert sum(parts.values()) < 4 * 1000 + 2 * len(shares)
    assert lookup.spread_parts({"k": 0.001}, 200) == {}


def test_probes_run_before_any_join(no_broadcast, fact, dim, monkeypatch):
    """One probe for all join columns, on the fact as it came in."""
    seen, probe = [], lookup.hot_keys

    def watch(df, keys):
        seen.append((df._jdf.queryExecution().optimizedPlan().toString(), keys))
        return probe(df, keys)

    monkeypatch.setattr(lookup, "hot_keys", watch)
    other = dim.select(F.col("k").alias("transaction_id"), F.col("name").alias("other")).distinct()
    third = dim.select("k", F.col("name").alias("third")).where("k <> 'hot'")
    joined = lookup.lookup_joins(fact, [(dim, "k"), (other, "transaction_id"), (third, "k")], ["transaction_id"])
    plain = fact.join(dim, "k", "left").join(other, "transaction_id", "left").join(third, "k", "left")
    assert [keys for _, keys in seen] == [["k", "transaction_id"]] and "Join" not in seen[0][0]
    names = sorted(plain.columns)
    assert Counter(map(tuple, joined.select(names).collect())) == Counter(map(tuple, plain.select(names).collect()))


def test_hot_and_null_keys_are_spread(no_broadcast, fact, dim):
    no_broadcast.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    joined = lookup._salted_join(fact, dim, "k", ["transaction_id"], "left", {"hot": 0.33})
    parts = joined.where("k = 'hot' OR k IS NULL").groupBy("k", F.spark_partition_id()).count()
    try:
        placed = Counter(r["k"] for r in parts.collect())
    finally:
        no_broadcast.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert placed["hot"] > 3 and placed[None] > 3


def test_copies_of_one_row_are_spread(no_broadcast, spark, dim):
    """All rows alike: their input partitions tell them apart."""
    rows = spark.range(0, 4000, 1, 40).selectExpr("'t' AS transaction_id", "'hot' AS k")
    no_broadcast.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = lookup._salted_join(rows, dim, "k", ["transaction_id"], "left", {"hot": 1.0})
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 8000 and len(sizes) > 3
    finally:
        no_broadcast.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_shared_columns_are_refused(fact, dim):
    with pytest.raises(ValueError, match="name"):
        lookup.lookup_join(fact.withColumn("name", F.lit(1)), dim, "k", ["transaction_id"])
