"""Exact order statistics without a global sort.

A median or a tertile needs only the rows at a few positions of a total order.
These are found by narrowing: bounds drawn from a sample, close to where each
position is expected, split the rows into ranges; one grouped count tells which
range holds the position, and the next round looks into that range only. The sample
decides how fast this goes, never what it returns. Rounds go on until a range is
at most a quarter of an average shuffle partition, whatever the size of the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A range that is ranked in one task is at most this part of an average partition.
RANGE_PART = 4
SAMPLE_ROWS = 20_000
# Bounds per round. From about 20 pairs on, the generated code of the search outgrows
# what the JVM compiles, and a round takes seven times as long.
BOUNDS = 12


@dataclass
class _Range:
    """Rows strictly between two key tuples; None stands for an open end."""

    low: tuple | None
    high: tuple | None
    before: int
    size: int
    positions: list[int] = field(default_factory=list)


def rows_at(
    df: DataFrame,
    keys: list[str],
    positions: list[int],
    total: int,
    max_range: int | None = None,
) -> dict[int, tuple]:
    """Key tuples at 1-based ``positions`` of ``df`` in ascending order of ``keys``.

    ``total`` is the row count. Keys must be free of nulls and come out the same
    on every evaluation: integers, decimals and text, not sums of doubles.
    """
    limit = largest_range(df, total) if max_range is None else max_range
    wanted = sorted({p for p in positions if 1 <= p <= total})
    rows = df.select(*keys)
    found: dict[int, tuple] = {}
    ranges = [_Range(None, None, 0, total, wanted)] if wanted else []
    round_no = 0
    while any(r.size > limit for r in ranges):
        wide = [r for r in ranges if r.size > limit]
        ranges = [r for r in ranges if r.size <= limit]
        ranges += _split(rows, keys, wide, found, seed=round_no)
        round_no += 1
    if ranges:
        found.update(_pick(rows, keys, ranges))
    return found


def largest_range(df: DataFrame, total: int) -> int:
    """Rows that may be ranked in one task: a fixed part of a shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, total // (RANGE_PART * partitions))


def _split(
    rows: DataFrame, keys: list[str], wide: list[_Range], found: dict, seed: int
) -> list[_Range]:
    """Narrow ``wide`` by one round; positions that hit a bound go to ``found``."""
    scope = rows.where(_within(keys, wide))
    share = min(1.0, SAMPLE_ROWS / sum(r.size for r in wide))
    sample = sorted(tuple(r) for r in scope.sample(share, seed).collect())
    bounds = set()
    for r in wide:
        inside = [s for s in sample if _between(s, r.low, r.high)]
        bounds.update(_near(inside, r, BOUNDS // len(wide)))
        bounds.update(edge for edge in (r.low, r.high) if edge is not None)
    ordered = sorted(bounds)
    place = _place(keys, ordered, 0, len(ordered)).alias("place")
    counts = dict(map(tuple, scope.groupBy(place).count().collect()))
    narrowed = []
    for r in wide:
        first = 0 if r.low is None else 2 * ordered.index(r.low) + 2
        last = 2 * len(ordered) if r.high is None else 2 * ordered.index(r.high)
        before = r.before
        for slot in range(first, last + 1):
            size = counts.get(slot, 0)
            hits = [p for p in r.positions if before < p <= before + size]
            if hits and slot % 2:
                found.update({p: ordered[slot // 2] for p in hits})
            elif hits:
                low = ordered[slot // 2 - 1] if slot else None
                high = ordered[slot // 2] if slot // 2 < len(ordered) else None
                narrowed.append(_Range(low, high, before, size, hits))
            before += size
    return narrowed


def _near(inside: list[tuple], r: _Range, number: int) -> set[tuple]:
    """About ``number`` sample rows around the expected places of the positions.

    A position lies within two square roots of the sample size of its expected place
    but for a rare case, which only costs another round.
    """
    reach = 2 * math.isqrt(len(inside)) + 1
    centres = {(p - r.before) * len(inside) // r.size for p in r.positions}
    step = max(1, 2 * reach * len(centres) // max(1, number))
    spots = set()
    for centre in centres:
        spots.update(range(max(0, centre - reach), min(len(inside), centre + reach + 1), step))
    return {inside[i] for i in spots}


def _pick(rows: DataFrame, keys: list[str], ranges: list[_Range]) -> dict[int, tuple]:
    """Rank the rows of ranges that are small enough and read off the positions."""
    number = F.lit(None).cast("int")
    for i, r in enumerate(ranges):
        number = F.when(_inside(keys, r), i).otherwise(number)
    place = F.row_number().over(Window.partitionBy("range").orderBy(*keys))
    wanted = [
        (F.col("range") == i) & F.col("place").isin([p - r.before for p in r.positions])
        for i, r in enumerate(ranges)
    ]
    picked = (
        rows.where(_within(keys, ranges))
        .withColumn("range", number)
        .withColumn("place", place)
        .where(reduce(or_, wanted))
        .collect()
    )
    return {row["place"] + ranges[row["range"]].before: tuple(row[k] for k in keys) for row in picked}


def _place(keys: list[str], bounds: list[tuple], start: int, stop: int) -> Column:
    """Slot of a row: 2i below bound i, 2i + 1 on it. A search tree, not a chain."""
    if start == stop:
        return F.lit(2 * start)
    middle = (start + stop) // 2
    return (
        F.when(_less(keys, bounds[middle]), _place(keys, bounds, start, middle))
        .when(_equal(keys, bounds[middle]), F.lit(2 * middle + 1))
        .otherwise(_place(keys, bounds, middle + 1, stop))
    )


def _within(keys: list[str], ranges: list[_Range]) -> Column:
    return reduce(or_, [_inside(keys, r) for r in ranges])


def _inside(keys: list[str], r: _Range) -> Column:
    above = F.lit(True) if r.low is None else ~up_to(keys, r.low)
    below = F.lit(True) if r.high is None else _less(keys, r.high)
    return above & below


def _between(item: tuple, low: tuple | None, high: tuple | None) -> bool:
    return (low is None or item > low) and (high is None or item < high)


def _less(keys: list[str], bound: tuple) -> Column:
    """Row key tuple before ``bound`` in lexicographic order."""
    head = F.col(keys[0])
    smaller = head < F.lit(bound[0])
    if len(keys) == 1:
        return smaller
    return smaller | ((head == F.lit(bound[0])) & _less(keys[1:], bound[1:]))


def _equal(keys: list[str], bound: tuple) -> Column:
    same = F.col(keys[0]) == F.lit(bound[0])
    return same if len(keys) == 1 else same & _equal(keys[1:], bound[1:])


def up_to(keys: list[str], bound: tuple) -> Column:
    """Row key tuple before or equal to ``bound``."""
    return _less(keys, bound) | _equal(keys, bound)


def median(df: DataFrame, column: str, total: int | None = None) -> float | None:
    """Middle value; the mean of the two middle ones for an even row count."""
    rows = df.where(F.col(column).isNotNull())
    n = rows.count() if total is None else total
    return _middle(rows_at(rows, [column], [(n + 1) // 2, n // 2 + 1], n), 0, n)


def lower_median(df: DataFrame, column: str, total: int | None = None):
    """Middle value; the smaller of the two middle ones for an even row count."""
    rows = df.where(F.col(column).isNotNull())
    n = rows.count() if total is None else total
    found = rows_at(rows, [column], [(n + 1) // 2], n)
    return found[(n + 1) // 2][0] if n else None


def grouped_medians(df: DataFrame, group: str, column: str) -> dict:
    """Median of ``column`` per value of a ``group`` with few values.

    The groups lie one after another in the order of (group, column), so all
    medians are positions of one order and no group is gathered in a task.
    """
    rows = df.where(F.col(group).isNotNull() & F.col(column).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(group).count().collect()}
    starts, positions, total = {}, [], 0
    for value in sorted(sizes):
        starts[value] = total
        positions += [total + (sizes[value] + 1) // 2, total + sizes[value] // 2 + 1]
        total += sizes[value]
    found = rows_at(rows, [group, column], positions, total)
    return {v: _middle(found, starts[v], sizes[v]) for v in sizes}


def _middle(found: dict[int, tuple], start: int, n: int) -> float | None:
    if n == 0:
        return None
    low, high = found[start + (n + 1) // 2][-1], found[start + n // 2 + 1][-1]
    return (float(low) + float(high)) / 2


def tertile_ends(n: int) -> tuple[int, int]:
    """Last positions of the lower two thirds when positions 1..n are cut at their
    linear quantiles 1/3 and 2/3, bounds belonging to the lower part."""
    return (n - 1) // 3 + 1, 2 * (n - 1) // 3 + 1


def ntile_ends(n: int) -> tuple[int, int]:
    """Last positions of the first two of three tiles; early tiles take the rest."""
    size, rest = divmod(n, 3)
    first = size + (rest > 0)
    return first, first + size + (rest > 1)


def thirds(
    df: DataFrame, value: str, tie: str, total: int, ends: tuple[int, int]
) -> Column:
    """Score 1 to 3 by the position of (``value``, ``tie``); a row expression."""
    if total == 0:
        return F.lit(None).cast("int")
    keys = [value, tie]
    rows = df.where(F.col(value).isNotNull())
    found = rows_at(rows, keys, list(ends), total)
    score = F.lit(3)
    for number, end in ((2, ends[1]), (1, ends[0])):
        if end in found:
            score = F.when(up_to(keys, found[end]), number).otherwise(score)
    return F.when(F.col(value).isNotNull(), score).cast("int")


def value_thirds(df: DataFrame, value: str, total: int) -> Column:
    """Score 1 to 3 by comparing an integer with the linear quantiles 1/3 and 2/3.

    Equal values share a score. Both sides are kept times three, so the comparison
    is exact in integers; with few distinct values some scores stay empty.
    """
    if total == 0:
        return F.lit(None).cast("int")
    rows = df.where(F.col(value).isNotNull())
    spots = [divmod(part * (total - 1), 3) for part in (1, 2)]
    positions = [p for spot, _ in spots for p in (spot + 1, min(spot + 2, total))]
    found = rows_at(rows, [value], positions, total)
    edges = []
    for spot, rest in spots:
        low, high = found[spot + 1][0], found[min(spot + 2, total)][0]
        edges.append(3 * low + rest * (high - low))
    tripled = F.col(value) * 3
    score = F.when(tripled <= edges[0], 1).when(tripled <= edges[1], 2).otherwise(3)
    return F.when(F.col(value).isNotNull(), score).cast("int")
