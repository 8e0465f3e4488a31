"""Monthly cohorts and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions import month_of, months_from

PERIODS = list(range(8))
#: Months in a word of a customer's calendar: five years, so that no bit is the sign.
WORD = 60


def visits(clean: DataFrame) -> DataFrame:
    """First date per customer and order; keyed by both, so hot customers spread."""
    known = clean.where(F.col("customer_id").isNotNull() & F.col("order_key").isNotNull())
    return known.groupBy("customer_id", "order_key").agg(F.min("order_date").alias("order_date"))


def calendars(clean: DataFrame) -> DataFrame:
    """One row per customer with a dated order: ``cohort``, and ``words``, the months with a purchase as bits.

    A word has a bit for each of WORD months. Bits are joined by or in every task before a customer's rows meet, so a
    customer arrives once per task and word. All functions below take such a table, stored, in place of the orders.
    """
    dated = visits(clean).where(F.col("order_date").isNotNull())
    month = F.year("order_date") * 12 + F.month("order_date") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(month, F.lit(WORD)))
    words = dated.groupBy("customer_id", F.floor(month / WORD).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    lowest = F.bit_count(F.col("bits").bitwiseAND(-F.col("bits")) - 1)
    return words.groupBy("customer_id").agg(
        _month(F.min(F.col("word") * WORD + lowest)).alias("cohort"),
        F.collect_list(F.struct("word", "bits")).alias("words"),
    )


def _month(number: Column) -> Column:
    """First day of the month with this number, counted from the year 0."""
    return F.make_date(F.floor(number / 12).cast("int"), (number % 12 + 1).cast("int"), F.lit(1))


def _calendars(orders: DataFrame) -> DataFrame:
    return orders if "words" in orders.columns else calendars(orders)


def active_months(clean: DataFrame) -> DataFrame:
    """One row per customer and month with a purchase: cohort and months since it."""
    places = F.sequence(F.lit(0), F.lit(WORD - 1))
    held = F.transform(
        "words",
        lambda w: F.transform(F.filter(places, lambda p: F.getbit(w["bits"], p) == 1), lambda p: w["word"] * WORD + p),
    )
    months = _calendars(clean).select("customer_id", "cohort", F.explode(F.flatten(held)).alias("number"))
    dated = months.withColumn("order_month", _month(F.col("number"))).drop("number")
    return dated.withColumn("period_n", months_from(F.col("cohort"), F.col("order_month")))


def customer_cohorts(clean: DataFrame) -> DataFrame:
    return _calendars(clean).select("customer_id", "cohort")


def cohort_sizes(clean: DataFrame) -> DataFrame:
    return customer_cohorts(clean).groupBy("cohort").agg(F.count("*").alias("cohort_size"))


def cohort_activity(clean: DataFrame) -> DataFrame:
    """Distinct customers per cohort and period."""
    return active_months(clean).groupBy("cohort", "period_n").agg(F.count("*").alias("active_n"))


def sized_activity(clean: DataFrame) -> DataFrame:
    """Activity with the cohort's size, which is its activity in period 0.

    One row per cohort and period: no more than the square of the calendar's months.
    """
    start = F.max(F.when(F.col("period_n") == 0, F.col("active_n")))
    size = start.over(Window.partitionBy("cohort"))
    return cohort_activity(clean).withColumn("cohort_size", size)


def retention_long(clean: DataFrame, rows: int | None = 50) -> DataFrame:
    """Retention of periods 0 to 7 in cohort order; ``rows`` None returns all."""
    share = F.round(_share(F.col("active_n")), 3).alias("retention")
    out = (
        sized_activity(clean)
        .where(F.col("period_n").between(PERIODS[0], PERIODS[-1]))
        .select("cohort", "period_n", "active_n", "cohort_size", share)
        .orderBy("cohort", "period_n")
    )
    return out if rows is None else out.limit(rows)


def retention_matrix(
    clean: DataFrame, periods: list[int] = PERIODS, rows: int | None = None
) -> DataFrame:
    """One row per cohort, one column per period, 0 where nobody was active.

    ``rows`` keeps the first cohorts only.
    """
    wide = sized_activity(clean).groupBy("cohort").pivot("period_n", periods)
    cells = wide.agg(F.round(F.max(_share(F.col("active_n"))), 3))
    names = [F.col(str(p)).alias(f"period_{p}") for p in periods]
    out = cells.select("cohort", *names).fillna(0.0).orderBy("cohort")
    return out if rows is None else out.limit(rows)


def retention_full(clean: DataFrame) -> DataFrame:
    """Every cohort with every period that any cohort has, unrounded."""
    everywhere = F.collect_set("period_n").over(Window.partitionBy())
    cohorts = (
        sized_activity(clean)
        .withColumn("periods", everywhere)
        .groupBy("cohort")
        .agg(
            F.max("cohort_size").alias("cohort_size"),
            F.first("periods").alias("periods"),
            F.map_from_entries(F.collect_list(F.struct("period_n", "active_n"))).alias("seen"),
        )
    )
    active = F.coalesce(F.element_at("seen", F.col("period_n")), F.lit(0))
    return (
        cohorts.select("cohort", "cohort_size", "seen", F.explode("periods").alias("period_n"))
        .withColumn("active_n", active.cast("long"))
        .withColumn("retention", _share(F.col("active_n")))
        .drop("seen")
    )


def first_period_median(clean: DataFrame, observed_only: bool = False) -> DataFrame:
    """Median retention in period 1 over the cohorts, null if no cohort has one.

    A cohort of the last month counts as 0 unless ``observed_only`` leaves it out.
    """
    cohorts = sized_activity(clean).groupBy("cohort").agg(
        F.max("cohort_size").alias("cohort_size"),
        F.max(F.when(F.col("period_n") == 1, F.col("active_n"))).alias("active"),
        F.max(F.add_months("cohort", F.col("period_n"))).alias("last_month"),
    )
    if observed_only:
        end = F.max("last_month").over(Window.partitionBy())
        cohorts = cohorts.withColumn("end", end).where(F.col("cohort") < F.col("end"))
    middle = F.round(F.median(_share(F.coalesce(F.col("active"), F.lit(0)))), 3)
    seen = F.max("active").isNotNull()
    return cohorts.agg(F.when(seen, middle).alias("period_1_median"))


def cohort_summary(clean: DataFrame) -> DataFrame:
    return cohort_sizes(clean).agg(
        F.count("*").alias("cohorts"),
        F.min("cohort_size").alias("size_min"),
        F.median("cohort_size").alias("size_median"),
        F.max("cohort_size").alias("size_max"),
    )


def cohort_summary_of_people(people: DataFrame) -> DataFrame:
    sizes = people.groupBy(month_of("first_order").alias("cohort")).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.count("*").alias("cohorts_n"), F.min("n").alias("size_min"), F.max("n").alias("size_max")
    )


def _share(active: Column) -> Column:
    return active.cast("double") / F.col("cohort_size").cast("double")
