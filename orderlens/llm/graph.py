"""Connected components of a graph given as pairs of 64-bit ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.storage import store


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step: edges (a, b), a > b, that point to smaller and smaller ids.

    The least neighbour is an aggregate with map-side combine, joined back to the edges by a join that
    Spark splits where a node has very many of them.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    large = (
        both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    large = large.filter("a != b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a")
    return (
        small.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        .unionByName(small.select("a", F.col("m").alias("b")))
        .filter("a != b")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least id that can be reached) of every node with an edge.

    ``edges`` has columns a and b. The number of rounds grows with the logarithm of the longest path. Each
    round is stored in the shared folder, so the lineage stays short.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    edges, last = store(edges, "edges"), None
    while True:
        # Sums of hashes and counts tell whether a round has changed anything.
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")
        ).first()
        if state == last or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        last, edges = state, store(_stars(edges), "edges")
