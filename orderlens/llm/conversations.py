"""Turns of conversations as numbers: order, digests of contents, sizes; and conversations made of others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.lookup import lookup_join
from orderlens.operators.running import running
from orderlens.operators.storage import store

#: What is kept of a turn: two hashes of role and text (128 bits), and the text's bytes in UTF-8.
CONTENT = ["first", "second", "size"]


def numbered_turns(table: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1) and content of every turn of ``table`` (``conv_id``, ``turn``, ``role``, ``text``).

    Turns are ordered by ``turn``, null first; equal ones by the hashes of their contents. Null role or text is the
    empty string. Rows without a ``conv_id`` belong to no conversation and are left out; repeated rows are turns
    each for itself; other columns are not read. A conversation with a large part of all rows is spread over
    many tasks.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = table.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("first"),
        F.xxhash64(F.lit(1), role, text).alias("second"),
        F.octet_length(text).cast("long").alias("size"),
    )
    return running(turns, ["conv_id"], ["turn", "first", "second"], number="place").select("conv_id", "place", *CONTENT)


def with_borrowed_beginnings(turns: DataFrame, base: Column, borrowed: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are replaced by those of another one.

    ``turns`` are numbered and stored. ``base`` and ``borrowed`` are expressions of ``conv_id``: the conversation to
    take from, and how many turns (``most`` at most). Fewer are taken if it has fewer, none if it does not
    exist; the own turns from ``borrowed`` + 1 on follow. Returns the new turns, and all ``conv_id`` with the number
    of turns ``taken``, those that have no turns left included.
    """
    heads = turns.where(F.col("place") <= most).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", *CONTENT))).alias("head")  # at most ``most`` turns
    )
    heads = store(heads, "heads")
    given = heads.select(F.col("conv_id").alias("base_id"), F.col("head").alias("given"))
    convs = heads.select("conv_id", base.alias("base_id"), borrowed.alias("borrowed")).join(given, "base_id", "left")
    taken = F.filter("given", lambda t: t["place"] <= F.col("borrowed"))
    convs = store(convs.select("conv_id", F.coalesce(taken, F.array()).alias("turns")), "borrowed")
    sized = convs.select("conv_id", F.size("turns").cast("long").alias("taken"))
    own = turns.withColumn("borrowed", borrowed).where(F.col("place") > F.col("borrowed"))
    own = lookup_join(own, sized, "conv_id", ["place"], "inner")
    moved = (F.col("taken") + F.col("place") - F.col("borrowed")).alias("place")
    return (
        convs.select("conv_id", F.inline("turns")).unionByName(own.select("conv_id", moved, *CONTENT)),
        sized,
    )
