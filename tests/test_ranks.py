"""Rank selection against sorting in memory."""

from __future__ import annotations

import random
from decimal import Decimal
from statistics import median, median_low

import pytest
from pyspark.sql import functions as F

from orderlens.operators import ranks


def pairs(n, kind, seed=1):
    rng = random.Random(seed)
    values = {
        "spread": lambda i: rng.randint(0, 10**9),
        "ties": lambda i: rng.choice([1, 2, 2, 2, 3, 50]),
        "one value holds most": lambda i: 7 if rng.random() < 0.7 else rng.randint(0, 100),
        "all equal": lambda i: 5,
    }[kind]
    return [(values(i), str(i)) for i in range(n)]


@pytest.mark.parametrize("kind", ["spread", "ties", "one value holds most", "all equal"])
@pytest.mark.parametrize("limit", [50, 10**6])
def test_positions_match_a_sort(spark, kind, limit):
    rows = pairs(3000, kind)
    df = spark.createDataFrame(rows, "v long, id string").repartition(5)
    wanted = [1, 2, 999, 1000, 1001, 1500, 2999, 3000]
    ordered = sorted(rows)
    found = ranks.rows_at(df, ["v", "id"], wanted, 3000, max_range=limit)
    assert found == {p: ordered[p - 1] for p in wanted}
    by_value = ranks.rows_at(df, ["v"], wanted, 3000, max_range=limit)
    assert by_value == {p: (ordered[p - 1][0],) for p in wanted}


def test_no_task_gets_more_than_the_limit(spark, monkeypatch):
    df = spark.createDataFrame(pairs(5000, "ties"), "v long, id string")
    seen = []
    pick = ranks._pick

    def watch(rows, keys, ranges):
        seen.extend(r.size for r in ranges)
        return pick(rows, keys, ranges)

    monkeypatch.setattr(ranks, "_pick", watch)
    ranks.rows_at(df, ["v", "id"], [1700, 3400], 5000, max_range=100)
    assert seen and max(seen) <= 100


@pytest.mark.parametrize("n", [40, 5000])
def test_rounds_are_run_at_every_size(spark, monkeypatch, n):
    """No constant is patched: each size is split, and no range is above the stated part."""
    df = spark.createDataFrame(pairs(n, "spread"), "v long, id string")
    limit = ranks.largest_range(df, n)
    assert limit == max(1, n // 32)
    rounds, seen = [], []
    split, pick = ranks._split, ranks._pick
    monkeypatch.setattr(ranks, "_split", lambda *a, **k: rounds.append(1) or split(*a, **k))
    monkeypatch.setattr(ranks, "_pick", lambda *a: seen.extend(r.size for r in a[2]) or pick(*a))
    found = ranks.rows_at(df, ["v", "id"], [n // 3, n // 2], n)
    assert found == {p: sorted(pairs(n, "spread"))[p - 1] for p in (n // 3, n // 2)}
    assert rounds and all(size <= limit for size in seen)


def test_positions_outside_and_empty_input(spark):
    df = spark.createDataFrame([(1, "a")], "v long, id string")
    assert ranks.rows_at(df, ["v"], [0, 2], 1) == {}
    assert ranks.rows_at(df.limit(0), ["v"], [1], 0) == {}
    assert ranks.median(df.limit(0), "v") is None
    assert ranks.lower_median(df.limit(0), "v") is None


@pytest.mark.parametrize("values", [[1, 2, 3, 10], [4], [3, 1, 2], [None, 1, None, 4]])
def test_medians(spark, monkeypatch, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    df = df.withColumn("v", F.col("v").cast("decimal(18,2)"))
    known = [v for v in values if v is not None]
    assert ranks.median(df, "v") == median(known)
    assert ranks.lower_median(df, "v") == Decimal(median_low(known))
    monkeypatch.setattr(ranks, "RANGE_PART", 10**9)
    assert ranks.median(df, "v") == median(known)


def test_grouped_medians(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice([0, 0, 0, 1, None]), rng.randint(0, 40)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g int, v long")
    expected = {g: median(v for h, v in rows if h == g) for g in (0, 1)}
    assert ranks.grouped_medians(df, "g", "v") == expected
    monkeypatch.setattr(ranks, "RANGE_PART", 8)
    assert ranks.grouped_medians(df, "g", "v") == expected


@pytest.mark.parametrize(
    ("n", "quantiles", "tiles"),
    [(4, [2, 1, 1], [2, 1, 1]), (5, [2, 1, 2], [2, 2, 1]), (6, [2, 2, 2], [2, 2, 2])],
)
def test_third_sizes_and_text_ties(spark, n, quantiles, tiles):
    """Equal values: the text order of the ids decides, "10" before "9"."""
    ids = [str(i) for i in range(12 - n, 12)]
    df = spark.createDataFrame([(1, i) for i in ids], "v long, id string")
    for ends, sizes in ((ranks.tertile_ends(n), quantiles), (ranks.ntile_ends(n), tiles)):
        scored = df.withColumn("s", ranks.thirds(df, "v", "id", n, ends))
        got = {r["id"]: r["s"] for r in scored.collect()}
        expected = [s for s, size in zip((1, 2, 3), sizes) for _ in range(size)]
        assert [got[i] for i in sorted(ids)] == expected


def test_ntile_ends_equal_the_window(spark):
    for n in range(1, 12):
        df = spark.range(n).selectExpr("id", "ntile(3) OVER (ORDER BY id) AS t")
        first, second = ranks.ntile_ends(n)
        expected = [1 if i < first else 2 if i < second else 3 for i in range(n)]
        assert [r["t"] for r in df.orderBy("id").collect()] == expected


def test_value_thirds_keep_ties_together(spark):
    def scores(values):
        df = spark.createDataFrame([(v,) for v in values], "v int")
        scored = df.withColumn("s", ranks.value_thirds(df, "v", len(values)))
        return [r["s"] for r in scored.orderBy("v").collect()]

    assert scores([5, 5, 5, 5, 5]) == [1, 1, 1, 1, 1]
    assert scores([1, 2, 3, 4, 5, 6, 7]) == [1, 1, 1, 2, 2, 3, 3]
    assert scores([1, 1, 1, 1, 9]) == [1, 1, 1, 1, 3]
    assert scores([3]) == [1]
