"""Row numbers and running digests against plain Python."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from orderlens.operators.running import running


def test_numbers_within_groups(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.randrange(50), rng.getrandbits(40)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g string, v int, h long").repartition(5)
    got = running(df, ["g"], ["v", "h"], number="place", xors={"x": "h"}, sums={"s": "v"}, parts=16).collect()
    assert len(got) == len(rows)
    for group in {r[0] for r in rows}:
        want = sorted((v, h) for g, v, h in rows if g == group)
        own = sorted((r for r in got if r.g == group), key=lambda r: r.place)
        assert [r.place for r in own] == list(range(1, len(want) + 1))
        assert [(r.v, r.h) for r in own] == want
        digest = total = 0
        for r in own:
            digest ^= r.h
            total += r.v
            assert (r.x, r.s) == (digest, total)


def test_whole_table_copies_and_no_rows(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("v")).repartition(7)
    got = running(df, [], ["v"], number="n", parts=9).collect()
    assert sorted(r.n for r in got) == list(range(1, 1001))
    assert {r.v for r in got if r.n <= 500} == {0}
    assert running(df.limit(0), [], ["v"], number="n").collect() == []


def test_copies_of_one_row_are_spread(spark):
    """Equal rows do not all go to one part."""
    from orderlens.operators import running as module

    seen = []
    store = module.store
    try:
        module.store = lambda df, label: seen.append(store(df, label)) or seen[-1]
        running(spark.range(8000, numPartitions=8).select(F.lit(1).alias("g"), F.lit(1).alias("v")), ["g"], ["v"], number="n", parts=8).collect()
    finally:
        module.store = store
    sizes = [r["count"] for r in seen[0].groupBy("_part").count().collect()]
    assert max(sizes) < 2500
