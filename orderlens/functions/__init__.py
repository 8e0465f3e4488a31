"""Column expressions shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.schemas import MARGIN, MONEY

MONTH_FIRST = r"^\s*(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{4})"


# Tried in this order on what is neither ISO nor month-first with a full year.
DATE_FORMATS = [
    "M/d/yyyy h:mm a",
    "M/d/yyyy h:mm:ss a",
    "MMM d yyyy",
    "MMM d, yyyy",
    "MMMM d yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
    "yyyyMMdd",
    "yyyy/M/d",
]
SHORT_YEAR_FORMATS = ["M/d/yy", "M-d-yy", "M/d/yy h:mm a"]
OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(column: Column) -> Column:
    """Text without white space at its ends, in the sense of Unicode."""
    return F.regexp_replace(column.cast("string"), OUTER_SPACE, "")


def clean_id(name: str) -> Column:
    """Identifier as text without outer white space; a null stays null."""
    return strip(F.col(name)).alias(name)


def to_money(column: Column | str) -> Column:
    """Amount as an exact decimal, null where the text is not a number."""
    return _col(column).try_cast(MONEY)


def to_margin(column: Column | str) -> Column:
    return _col(column).try_cast(MARGIN)


def to_timestamp(column: Column | str) -> Column:
    """Timestamp without zone: ISO, month-first, or one of the listed formats, else null.

    Years of two digits from 69 on belong to the last century.
    """
    text = strip(_col(column))
    iso = F.regexp_replace(text, MONTH_FIRST, "$3-$1-$2").try_cast("timestamp_ntz")

    def parsed(form: str) -> Column:
        return F.try_to_timestamp(text, F.lit(form)).cast("timestamp_ntz")

    def century(value: Column) -> Column:
        earlier = value - F.make_ym_interval(F.lit(100), F.lit(0))
        return F.when(F.year(value) >= 2069, earlier).otherwise(value)

    return F.coalesce(
        iso, *map(parsed, DATE_FORMATS), *(century(parsed(f)) for f in SHORT_YEAR_FORMATS)
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    share = F.lit(100.0) * numerator.cast("double")
    share = F.try_divide(share, denominator.cast("double"))
    return share if digits is None else F.round(share, digits)


def money_sum(column: Column | str = "order_value") -> Column:
    """Exact sum of an amount. Decimal sums do not depend on the row order."""
    return F.sum(_col(column).cast(MONEY))


def profit_units(value: str = "order_value", margin: str = "margin_percentage") -> Column:
    """Row profit times 100: amount times margin percent, still an exact decimal."""
    return F.col(value).cast(MONEY) * F.col(margin).cast(MARGIN)


def profit_sum() -> Column:
    return F.sum(profit_units()).cast("double") / F.lit(100.0)


def mean(column: Column | str) -> Column:
    """Average as sum over count, exact for integers and decimals up to the division."""
    return ratio(F.sum(_col(column)), F.count(_col(column)))


def month_of(column: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_col(column), "month")


def months_from(start: Column, end: Column) -> Column:
    """Calendar months from one date to another, days ignored."""
    years = F.year(end) - F.year(start)
    return (years * 12 + F.month(end) - F.month(start)).cast("int")


def days_from(start: Column, end: Column) -> Column:
    """Completed 24-hour days from one timestamp to another, rounded down.

    The calendar distance is one too many when the clock time of ``end`` is the
    earlier one, so 23:00 to 01:00 on the next day is 0.
    """
    distance = F.datediff(end, start)
    incomplete = start + F.make_dt_interval(distance) > end
    return (distance - incomplete.cast("int")).cast("int")


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
