"""Quality of predictions: ROC area, confusion matrix, per-class report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.models.features import LABEL
from orderlens.operators.running import running


def roc_auc(scores: DataFrame, score: str = "probability", label: str = LABEL) -> float | None:
    """Exact area under the ROC curve by rank sums; equal scores share their mean rank.

    Rows become counts per distinct score first. Ranks are running counts over ranges of scores, doubled, so that
    all sums are exact integers. None if a class has no rows.
    """
    known = scores.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = known.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("ones")
    )
    ranked = running(counts, [], ["s"], sums={"until": "n"})
    wide = "decimal(38,0)"
    doubled = F.col("ones").cast(wide) * (2 * F.col("until") - F.col("n") + 1).cast("decimal(19,0)")
    total = ranked.agg(F.sum("ones"), F.sum("n"), F.sum(doubled.cast(wide))).first()
    ones, rows, twice = (int(v or 0) for v in total)
    if not 0 < ones < rows:
        return None
    return (twice - ones * (ones + 1)) / (2 * ones * (rows - ones))


def _rounded(area: float | None, digits: int) -> Column:
    return F.lit(None if area is None else round(area, digits)).cast("double")


def auc_table(scores: DataFrame, score: str = "probability", digits: int = 3) -> DataFrame:
    area = _rounded(roc_auc(scores, score), digits)
    return scores.agg(F.count("*").alias("rows_n")).withColumn("auc", area)


def confusion(scores: DataFrame) -> DataFrame:
    """Rows per true class and predicted class, empty cells included."""
    return _classes(scores).select(
        "label",
        F.when(F.col("label") == 0, F.col("hit")).otherwise(F.col("miss")).alias("predicted_0"),
        F.when(F.col("label") == 1, F.col("hit")).otherwise(F.col("miss")).alias("predicted_1"),
    )


def class_report(scores: DataFrame, digits: int = 3) -> DataFrame:
    """Precision, recall, F1 and support: per class, overall, and averaged.

    A ratio without cases is 0. Accuracy stands in the F1 column of its row.
    """
    ratios = (
        _classes(scores)
        .withColumn("precision", _or_zero("hit", F.col("hit") + F.col("false_alarm")))
        .withColumn("recall", _or_zero("hit", F.col("support")))
        .withColumn("f1", _or_zero(F.col("hit") * 2, F.col("hit") * 2 + F.col("false_alarm") + F.col("miss")))
    )
    values = ["precision", "recall", "f1"]
    per_class = ratios.select(F.col("label").cast("string").alias("class"), *values, "support")
    support = F.sum("support").alias("support")
    empty = F.lit(None).cast("double")
    overall = ratios.agg(
        F.lit("accuracy").alias("class"),
        empty.alias("precision"),
        empty.alias("recall"),
        _or_zero(F.sum("hit"), F.sum("support")).alias("f1"),
        support,
    )
    macro = ratios.agg(
        F.lit("macro avg").alias("class"), *(F.avg(v).alias(v) for v in values), support
    )
    weighted = ratios.agg(
        F.lit("weighted avg").alias("class"),
        *(_or_zero(F.sum(F.col(v) * F.col("support")), F.sum("support")).alias(v) for v in values),
        support,
    )
    table = per_class.unionByName(overall).unionByName(macro).unionByName(weighted)
    return table.withColumns({v: F.round(v, digits) for v in values})


def summary(scores: DataFrame, model: str) -> DataFrame:
    """One row: ROC area, accuracy, and precision, recall and F1 of class 1."""
    one = _classes(scores).agg(
        _or_zero(F.sum("hit"), F.sum("support")).alias("accuracy"),
        *(F.max(F.when(F.col("label") == 1, F.col(c))).alias(c) for c in ("hit", "false_alarm", "support")),
        F.sum("support").alias("rows_n"),
    )
    return one.select(
        F.lit(model).alias("model"),
        _rounded(roc_auc(scores), 3).alias("auc"),
        F.round("accuracy", 3).alias("accuracy"),
        F.round(_or_zero("hit", F.col("hit") + F.col("false_alarm")), 3).alias("precision"),
        F.round(_or_zero("hit", F.col("support")), 3).alias("recall"),
        "rows_n",
    )


def _classes(scores: DataFrame) -> DataFrame:
    """Two rows, one per class: support, hits, misses, false alarms; one pass."""
    truth, guess = F.col(LABEL) == 1, F.col("prediction") == 1
    cells = scores.agg(
        F.count_if(truth & guess).alias("tp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(~truth & ~guess).alias("tn"),
    )
    rows = F.array(
        F.struct(F.lit(0).alias("label"), F.col("tn").alias("hit"), F.col("fp").alias("miss"), F.col("fn").alias("false_alarm")),
        F.struct(F.lit(1).alias("label"), F.col("tp").alias("hit"), F.col("fn").alias("miss"), F.col("fp").alias("false_alarm")),
    )
    return cells.select(F.inline(rows)).withColumn("support", F.col("hit") + F.col("miss"))


def _or_zero(part: Column | str, whole: Column) -> Column:
    part = F.col(part) if isinstance(part, str) else part
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
