"""CSV records whose quoted fields hold line feeds, read by many tasks per file.

A line alone does not tell whether it begins inside a quoted field. So each line is taken as a step between the two
states, outside and inside: for either state before it, the state after it. Steps are put together within a file
block, the blocks' steps within the file, and only then it is known which lines begin a record. Records of a single line
stay where they are; the lines of the others are brought together by record.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.operators.storage import store

#: Columns of this module's own; the text of a record is in ``record``.
_FILE, _BLOCK, _LINE = "_file", "_block", "_line"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the start of their block, and their order inside it. Lines end in a line feed."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_BLOCK),
        F.monotonically_increasing_id().alias(_LINE),
        F.col("value").alias("text"),
    )


def ends_inside(text: Column) -> Column:
    """Whether a text that begins outside of quotes ends inside a quoted field.

    Doubled quotes and closed fields are taken out; a quote counts at the start of a field only.
    """
    rest = F.regexp_replace(F.regexp_replace(text, '""', ""), '(^|,)"[^"]*"', "$1")
    return F.when(F.contains(text, F.lit('"')), rest.rlike('(^|,)"[^"]*$')).otherwise(False)


def has_open_lines(lines: DataFrame) -> bool:
    """Whether any line leaves a quoted field open; without one, every line is a record."""
    return not lines.where(ends_inside(F.col("text"))).isEmpty()


def _with_states(steps: DataFrame, group: list[str], order: str) -> DataFrame:
    """``from0`` and ``from1``: whether a row is reached inside quotes, if its group begins outside or inside.

    ``after0`` and ``after1`` are a row's own steps. A step either keeps the state, or turns it, or sets it; so the
    state is the one last set, turned as often as steps turned it since.
    """
    line = Window.partitionBy(*group).orderBy(order)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("after0") & ~F.col("after1")).cast("int")
    sets = F.col("after0") == F.col("after1")
    counted = steps.withColumn("_turns", F.sum(turns).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    known = counted.withColumn("_set", F.last(F.when(sets, F.struct("after0", "_turns")), ignorenulls=True).over(before))
    known = known.withColumn("_turns", F.coalesce(F.lag("_turns").over(line), F.lit(0)))
    since = F.col("_turns") - F.coalesce("_set._turns", F.lit(0))
    odd = since % 2 == 1
    return known.withColumns(
        {f"from{s}": F.coalesce("_set.after0", F.lit(bool(s))) != odd for s in (0, 1)}
    ).drop("_turns", "_set")


def records(lines: DataFrame) -> DataFrame:
    """``record`` (text, without its line end) and ``first`` (whether it is the first of its file).

    A carriage return before the ending line feed belongs to the line end. A block is at most
    ``spark.sql.files.maxPartitionBytes`` long, so its lines fit a task; of the blocks there is one row each. A quote that
    is never closed takes all lines up to the end of its file, as with any reader.
    """
    steps = lines.withColumns(
        {"after0": ends_inside(F.col("text")), "after1": ends_inside(F.concat(F.lit('"'), F.col("text")))}
    )
    states = _with_states(steps, [_FILE, _BLOCK], _LINE)
    until = Window.partitionBy(_FILE, _BLOCK).orderBy(_LINE).rowsBetween(Window.unboundedPreceding, 0)
    counted = states.withColumns({f"starts{s}": F.count_if(~F.col(f"from{s}")).over(until) for s in (0, 1)})
    placed = store(counted, "lines")

    last = {f"after{s}": F.max_by(_after(s), _LINE).alias(f"after{s}") for s in (0, 1)}
    blocks = placed.groupBy(_FILE, _BLOCK).agg(*last.values(), *(F.max(f"starts{s}").alias(f"n{s}") for s in (0, 1)))
    # A file begins outside.
    reached = _with_states(blocks, [_FILE], _BLOCK).withColumn("inside", F.col("from0"))
    starts = F.when(F.col("inside"), F.col("n1")).otherwise(F.col("n0"))
    earlier = Window.partitionBy(_FILE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    open_ = F.last(F.when(starts > 0, F.struct(F.col(_BLOCK).alias("block"), starts.alias("number"))), ignorenulls=True)
    reached = reached.select(_FILE, _BLOCK, "inside", open_.over(earlier).alias("open"))

    joined = placed.join(reached, [_FILE, _BLOCK])
    number = F.when(F.col("inside"), F.col("starts1")).otherwise(F.col("starts0"))
    own = F.struct(F.col(_BLOCK).alias("block"), number.alias("number"))
    begins = ~F.when(F.col("inside"), F.col("from1")).otherwise(F.col("from0"))
    known = joined.select(
        _FILE,
        F.when(number > 0, own).otherwise(F.col("open")).alias("at"),
        _BLOCK,
        _LINE,
        "text",
        (begins & ~F.col("after0")).alias("whole"),
    )
    first = (F.col("at.block") == 0) & (F.col("at.number") == 1)
    whole = known.where("whole").select(_without_return(F.col("text")).alias("record"), first.alias("first"))
    pieces = F.array_sort(F.collect_list(F.struct(_BLOCK, _LINE, "text")))
    joint = (
        known.where("not whole")
        .groupBy(_FILE, "at")
        .agg(F.concat_ws("\n", F.transform(pieces, lambda p: p["text"])).alias("record"))
        .select(_without_return(F.col("record")).alias("record"), first.alias("first"))
    )
    return whole.unionByName(joint)


def _after(start: int) -> Column:
    """State after a line, if its block begins outside (0) or inside (1)."""
    return F.when(F.col(f"from{start}"), F.col("after1")).otherwise(F.col("after0"))


def _without_return(text: Column) -> Column:
    return F.regexp_replace(text, "\r$", "")


def table(lines: DataFrame) -> DataFrame:
    """The records as text columns named by the header, the first record of each file; blank records are left out."""
    found = store(records(lines), "records")
    # Files of a folder have the same header.
    header = found.where("first").agg(F.min("record")).first()[0]
    names = [name or f"_c{i}" for i, name in enumerate(next(csv.reader([header], doublequote=True)))]
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"escape": '"', "multiLine": "true"}
    body = found.where(~F.col("first") & (F.length(F.trim("record")) > 0))
    return body.select(F.from_csv("record", schema, options).alias("fields")).select("fields.*").toDF(*names)
