"""Recency, frequency and monetary scores with their segments.

Recency is counted from the latest order in the data. Two definitions exist: scores
by linear quantiles (equal recencies share a score) and scores by three equal tiles.
Frequency and amount ties are ordered by customer id in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import days_from, mean, percent
from orderlens.operators import ranks
from orderlens.operators.running import running
from orderlens.operators.storage import store


def rfm_base(clean: DataFrame, people: DataFrame, how: str = "left") -> DataFrame:
    """Per customer: days since the last order, order count, amount; stored.

    A customer table that carries ``last_order`` saves the second pass over orders.
    """
    if "last_order" not in people.columns:
        known = clean.where(F.col("customer_id").isNotNull())
        last = known.groupBy("customer_id").agg(F.max("order_date").alias("last_order"))
        people = people.join(last, "customer_id", how)
    latest = clean.agg(F.max("order_date")).scalar()
    return store(
        people.select(
            "customer_id",
            days_from(F.col("last_order"), latest).alias("recency"),
            F.col("orders").alias("frequency"),
            F.col("gmv").alias("monetary"),
        ),
        "rfm",
    )


def score_by_quantiles(clean: DataFrame, people: DataFrame) -> DataFrame:
    base = rfm_base(clean, people)
    return _segmented(base, *_quantile_scores(base))


def with_segments(clean: DataFrame, people: DataFrame) -> DataFrame:
    """The customer table (with ``last_order``) with ``segment`` and recency score ``R``, older ones replaced; stored.

    The scores are row expressions once the bounds are found, so the table is not joined with itself.
    """
    latest = clean.agg(F.max("order_date")).scalar()
    measures = {
        "recency": days_from(F.col("last_order"), latest),
        "frequency": F.col("orders"),
        "monetary": F.col("gmv"),
    }
    base = store(people.drop("segment", "R").withColumns(measures), "rfm")
    scored = _segmented(base, *_quantile_scores(base))
    return scored.withColumn("R", F.col("r_score")).drop(*measures, "r_score", "f_score", "m_score")


def _quantile_scores(base: DataFrame) -> tuple[Column, Column, Column]:
    n = _known(base)
    frequency, monetary = (
        ranks.thirds(base, name, "customer_id", n[name], ranks.tertile_ends(n[name]))
        for name in ("frequency", "monetary")
    )
    return 4 - ranks.value_thirds(base, "recency", n["recency"]), frequency, monetary


def ranks_of_customers(people: DataFrame) -> DataFrame:
    """Place of each customer by order count and by amount, from 1; equal ones by customer id."""
    base = people.select("customer_id", "orders", "gmv")
    counted = running(base, [], ["orders", "customer_id"], number="frequency_rank")
    return running(counted, [], ["gmv", "customer_id"], number="monetary_rank").select(
        "customer_id", "frequency_rank", "monetary_rank"
    )


def score_by_tiles(clean: DataFrame, people: DataFrame) -> DataFrame:
    base = rfm_base(clean, people, "inner")
    n = _known(base)
    recency, frequency, monetary = (
        ranks.thirds(base, name, "customer_id", n[name], ranks.ntile_ends(n[name]))
        for name in ("recency", "frequency", "monetary")
    )
    return _segmented(base, 4 - recency, frequency, monetary)


def segment_sizes(rfm: DataFrame, top: int = 10) -> DataFrame:
    """The segments with the most customers, with their amount."""
    sizes = rfm.groupBy("segment").agg(
        F.count("*").alias("customers"),
        F.round(F.sum("monetary").cast("double"), 0).alias("gmv"),
    )
    return sizes.orderBy(F.desc("customers"), "segment").limit(top)


def recency_summary(rfm: DataFrame) -> DataFrame:
    """Whole days have few distinct values, so the built-in median stays small."""
    return rfm.agg(
        F.min("recency").alias("recency_min"),
        F.median("recency").alias("recency_median"),
        F.max("recency").alias("recency_max"),
    )


def recency_averages(rfm: DataFrame) -> DataFrame:
    return rfm.agg(
        F.min("recency").alias("recency_min"),
        mean("recency").alias("recency_avg"),
        F.max("recency").alias("recency_max"),
    )


def champions_and_cold(rfm: DataFrame) -> DataFrame:
    """Size and amount share of the best segment and of the longest absent third."""
    champion, cold = F.col("segment") == "333", F.col("r_score") == 1
    return rfm.agg(
        F.count_if(champion).alias("champions"),
        _amount_share(champion).alias("champions_gmv_pct"),
        F.count_if(cold).alias("cold"),
        percent(F.count_if(cold), F.count("*"), 1).alias("cold_pct"),
        _amount_share(cold).alias("cold_gmv_pct"),
    )


def customers_by_recency(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("r_score").agg(F.count("*").alias("customers")).orderBy("r_score")


def _known(base: DataFrame) -> dict[str, int]:
    names = ["recency", "frequency", "monetary"]
    return base.agg(*(F.count(name).alias(name) for name in names)).first().asDict()


def _segmented(base: DataFrame, r: Column, f: Column, m: Column) -> DataFrame:
    scored = base.withColumns({"r_score": r, "f_score": f, "m_score": m})
    digits = [F.col(name).cast("string") for name in ("r_score", "f_score", "m_score")]
    return scored.withColumn("segment", F.concat(*digits))


def _amount_share(condition: Column) -> Column:
    part = F.sum(F.when(condition, F.col("monetary")).otherwise(0))
    return percent(part, F.sum("monetary"), 1)
