"""Equi-join of a fact with a keyed dimension, safe for hot and null keys."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators.storage import store

# Rows sampled to find hot keys: at least so many in all, and per share that is looked for.
SAMPLE_ROWS = 200_000
SAMPLE_PER_SHARE = 50
SALT = "_salt"


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: list[str],
    how: str = "left",
) -> DataFrame:
    """Add the columns of ``dim`` to ``fact``; see ``lookup_joins``."""
    return lookup_joins(fact, [(dim, key)], spread_by, how)


def lookup_joins(
    fact: DataFrame,
    dims: list[tuple[DataFrame, str]],
    spread_by: list[str],
    how: str = "left",
) -> DataFrame:
    """Add the columns of each dimension to ``fact``.

    A dimension whose size is within the session's broadcast limit is
    broadcast and the fact is not shuffled. A larger one is shuffled, with the rows
    of hot keys (and null keys, which match nothing) spread by a hash of
    ``spread_by`` and the input partition, so that even copies of one row part ways;
    only the dimension rows of hot keys are repeated. Every row is kept on both ways.

    The hot keys of all columns are found in one pass over the fact as it comes in, before any
    join; a dimension that has to be measured is stored first, so it is computed once.
    """
    seen = set(fact.columns)
    for dim, key in dims:
        shared = sorted((seen & set(dim.columns)) - {key})
        if shared:
            raise ValueError(f"columns on both sides of the join on {key}: {', '.join(shared)}")
        seen |= set(dim.columns)
    sized = [(*_sized(dim), key) for dim, key in dims]
    large = sorted({key for _, small, key in sized if not small})
    shares = hot_keys(fact, large) if large else {}
    for dim, small, key in sized:
        if small:
            fact = fact.join(F.broadcast(dim), key, how)
        else:
            fact = _salted_join(fact, dim, key, spread_by, how, shares[key])
    return fact


def _sized(dim: DataFrame) -> tuple[DataFrame, bool]:
    """The dimension, stored if it had to be measured, and whether it may be broadcast."""
    limit = broadcast_limit(dim)
    if limit <= 0:
        return dim, False
    if _estimate(dim) <= limit:
        return dim, True
    stored = store(dim, "dimension")
    return stored, _measured(stored) <= limit


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is within the session's broadcast limit.

    The optimizer's estimate is enough where it is small. It multiplies the sides of
    a join, so a large one is replaced by a measurement in one distributed pass.
    """
    limit = broadcast_limit(df)
    return limit > 0 and (_estimate(df) <= limit or _measured(df) <= limit)


def _estimate(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _measured(df: DataFrame) -> int:
    return df.agg(F.sum(_row_bytes(df))).first()[0] or 0


def broadcast_limit(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgt]?)b?\s*", text).groups()
    return int(number) * 1024 ** ["", "k", "m", "g", "t"].index(unit)


def hot_keys(df: DataFrame, keys: list[str]) -> dict[str, dict[str, float]]:
    """Per column the values, as text, above a quarter of an average partition, with their shares.

    They are read off one sample for all columns, down to half that share so that none is
    missed by chance: fewer than 8 per partition and column. The choice decides how rows are
    spread and has no influence on any result.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = 1 / (4 * partitions)
    total = df.count()
    if total == 0:
        return {key: {} for key in keys}
    wanted = max(SAMPLE_ROWS, SAMPLE_PER_SHARE / share)
    fraction = min(1.0, wanted / total)
    pairs = [F.struct(F.lit(i).alias("i"), F.col(k).cast("string").alias("v")) for i, k in enumerate(keys)]
    counts = (
        df.select(*keys)
        .sample(fraction, seed=1)
        .select(F.explode(F.array(*pairs)).alias("p"))
        .where(F.col("p.v").isNotNull())
        .groupBy("p.i", "p.v")
        .agg(F.count("*").alias("n"))
    )
    found: dict[str, dict[str, float]] = {key: {} for key in keys}
    for r in counts.where(F.col("n") > share / 2 * fraction * total).collect():
        found[keys[r["i"]]][r["v"]] = r["n"] / (fraction * total)
    return found


def spread_parts(shares: dict, partitions: int) -> dict:
    """Into how many parts each hot key is split; keys that stay whole are left out.

    A part is at most half an average partition. Numbers are powers of two, and all
    keys together have fewer than 4 * partitions + 2 * keys parts.
    """
    parts = {v: 2 ** math.ceil(math.log2(max(1.0, 2 * s * partitions))) for v, s in shares.items()}
    return {v: n for v, n in parts.items() if n > 1}


def _salted_join(
    fact: DataFrame, dim: DataFrame, key: str, spread_by: list[str], how: str, shares: dict[str, float]
) -> DataFrame:
    spark = fact.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = list(spread_parts(shares, partitions).items())
    # A row per hot key: fewer than 8 per partition.
    table = F.broadcast(spark.createDataFrame(hot, "_value string, _parts int"))

    def with_parts(df: DataFrame) -> DataFrame:
        if not hot:
            return df.withColumn("_parts", F.lit(1))
        joined = df.join(table, F.col(key).cast("string") == F.col("_value"), "left").drop("_value")
        return joined.withColumn("_parts", F.coalesce("_parts", F.lit(1)))

    own = F.when(F.col(key).isNull(), partitions).otherwise(F.col("_parts"))
    # A retried task reads the same partition, hence gives its rows the same salts.
    salt = F.pmod(F.xxhash64(*spread_by, F.spark_partition_id()), own).cast("int")
    left = with_parts(fact).withColumn(SALT, F.when(own > 1, salt).otherwise(0)).drop("_parts")
    copies = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    right = with_parts(dim.where(F.col(key).isNotNull())).withColumn(SALT, copies).drop("_parts")
    return left.join(right, [key, SALT], how).drop(SALT)


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of one row: eight per field and the length of each text."""
    size = F.lit(16 + 8 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
    return size
