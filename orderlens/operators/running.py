"""Row numbers, running totals and running digests along a global order, without gathering a group in one task.

The rows are dealt out by ranges of (group, order), so a group with most of the rows is spread over many
parts. Numbers are taken within (group, part); what lies in the parts before is added from a table with at
most one row per part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.operators.storage import store

_PART, _ROW = "_part", "_row"


def running(
    df: DataFrame,
    group: list[str],
    order: list[Column | str],
    number: str | None = None,
    xors: dict[str, str] | None = None,
    sums: dict[str, str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """``df`` with ``number``, a row's place in its group from 1, and running exclusive ors and sums of columns.

    ``xors`` and ``sums`` name, for each new column, the column that is added up; the row itself is included. ``order``
    may hold any sortable columns; rows equal in all of them are numbered as they come in. Null is a group
    of its own. No ``group`` numbers the whole table.
    """
    folds = {new: (F.bit_xor, old) for new, old in (xors or {}).items()} | {new: (F.sum, old) for new, old in (sums or {}).items()}
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Equal rows part ways by the place they are read from.
    rows = df.withColumn(_ROW, F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(parts, *group, *order, _ROW)
    placed = store(ranged.withColumn(_PART, F.spark_partition_id()), "ranged")
    inside = Window.partitionBy(*group, _PART).orderBy(*order, _ROW)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = placed
    if number:
        own = own.withColumn(number, F.row_number().over(inside).cast("long"))
    own = own.withColumns({new: fold(old).over(so_far) for new, (fold, old) in folds.items()})
    return _with_parts_before(own, _before(placed, group, folds), group, number, folds).drop(_PART, _ROW)


def _before(placed: DataFrame, group: list[str], folds: dict[str, tuple]) -> DataFrame:
    """Per (group, part) that has rows of the group in earlier parts, their number, totals and digests.

    Only the group that a part begins with can have such rows, so there is at most one row per part.
    """
    sums = placed.groupBy(*group, _PART).agg(
        F.count("*").alias("_n"), *(fold(old).alias(f"_{new}") for new, (fold, old) in folds.items())
    )
    line = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    earlier = [F.sum("_n").over(line).alias("_n"), *(fold(f"_{new}").over(line).alias(f"_{new}") for new, (fold, _) in folds.items())]
    kept = sums.select(*(F.col(g).alias(f"_group{k}") for k, g in enumerate(group)), F.col(_PART).alias("_at"), *earlier)
    return kept.where(F.col("_n").isNotNull())


def _with_parts_before(own: DataFrame, before: DataFrame, group: list[str], number: str | None, folds: dict[str, tuple]) -> DataFrame:
    same = F.col(_PART) == F.col("_at")
    for k, g in enumerate(group):
        same &= own[g].eqNullSafe(F.col(f"_group{k}"))
    joined = own.join(F.broadcast(before), same, "left")
    added = {}
    for new, (fold, _) in folds.items():
        now, earlier = F.col(new), F.col(f"_{new}")
        added[new] = F.coalesce(now.bitwiseXOR(earlier) if fold is F.bit_xor else now + earlier, now, earlier)
    if number:
        added[number] = F.col(number) + F.coalesce("_n", F.lit(0))
    return joined.withColumns(added).drop(*before.columns)
