"""Split, preprocessing and the two classifiers."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct,
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.models import forest, newton
from orderlens.models.features import LABEL, column_kinds, numeric, with_missing_level
from orderlens.operators import ranks
from orderlens.operators.storage import store

SEED = 42
TEST_SHARE = 0.25
WEIGHT = "class_weight"


@dataclass
class Fitted:
    """A trained model: the stages that make its vector, the names in it, a coefficient or importance for each,
    and the test rows scored."""

    stages: PipelineModel
    feature_names: list[str]
    weights: np.ndarray
    intercept: float
    scores: DataFrame


@dataclass
class Prepared:
    """Stored feature rows, split; both classifiers are fitted on one such table."""

    id_column: str
    numbers: list[str]
    listed: list[str]
    train: DataFrame
    test: DataFrame
    sizes: dict[int, int]


def with_digest(features: DataFrame, id_column: str, seed: int = SEED) -> DataFrame:
    """Rows with a label, and ``digest``, a hash of the id that orders them for the split."""
    known = features.where(F.col(LABEL).isNotNull())
    return known.withColumn("digest", F.md5(F.concat_ws(":", F.col(id_column).cast("string"), F.lit(seed))))


def test_rows(placed: DataFrame, id_column: str) -> Column:
    """Whether a row is one of the first quarter of its class in the order of digests.

    The classes lie one after another in the order of (label, digest), so the last test row of
    each is a position of one order, and the split is a row expression.
    """
    sizes = {int(r[0]): r[1] for r in placed.groupBy(LABEL).count().collect()}
    ends, before = {}, 0
    for label in sorted(sizes):
        ends[label] = before + int(TEST_SHARE * sizes[label] + 0.5)
        before += sizes[label]
    keys = [LABEL, "digest", id_column]
    found = ranks.rows_at(placed, keys, list(ends.values()), before)
    test = F.lit(False)
    for label, end in ends.items():
        if end in found and found[end][0] == label:
            test = test | ((F.col(LABEL) == label) & ranks.up_to(keys, found[end]))
    return test


def split(features: DataFrame, id_column: str) -> tuple[DataFrame, DataFrame]:
    placed = with_digest(features, id_column)
    test = test_rows(placed, id_column)
    return placed.where(~test).drop("digest"), placed.where(test).drop("digest")


def split_shares(features: DataFrame, id_column: str) -> DataFrame:
    placed = with_digest(features, id_column)
    side = F.when(test_rows(placed, id_column), "test").otherwise("train").alias("side")
    return placed.groupBy(side).agg(
        F.count("*").alias("rows_n"),
        F.sum(LABEL).alias("positives"),
        (F.sum(LABEL) / F.count("*")).alias("positive_share"),
    )


def class_sizes(train: DataFrame) -> dict[int, int]:
    sizes = {int(r[0]): r[1] for r in train.groupBy(LABEL).count().collect()}
    if len(sizes) < 2:
        raise ValueError("the training rows hold a single class")
    return sizes


def with_balance(train: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """Weights that give both classes half of the total, adding up to the row count."""
    total = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for label, size in sizes.items():
        weight = F.when(F.col(LABEL) == label, total / (len(sizes) * size)).otherwise(weight)
    return train.withColumn(WEIGHT, weight)


def fit_logistic(features: DataFrame | Prepared, id_column: str, categories: list[str]) -> Fitted:
    """Logistic regression on standardised features, balanced classes.

    The penalty is half the squared norm against the weighted sum of losses.
    """
    ready = features if isinstance(features, Prepared) else prepare(features, id_column, categories)
    stages, names, train = _vectors(ready, scaled=True)
    rows = store(train.select(LABEL, F.col(WEIGHT).alias("weight"), "features"), "vectors")
    weights, intercept = newton.fit(rows, len(names))
    test = _as_arrays(stages.transform(ready.test))
    scores = test.select(id_column, LABEL, newton.probability(weights, intercept).alias("probability"))
    return Fitted(stages, names, weights, intercept, store(_with_prediction(scores), "scores"))


def fit_forest(
    features: DataFrame | Prepared,
    id_column: str,
    categories: list[str],
    trees: int,
    max_depth: int = 30,
    handed: int = forest.HANDED,
) -> Fitted:
    """Random forest on unscaled features, balanced classes.

    Trees grow as deep as the data asks, at most to ``max_depth``, and split on binned values. ``handed``: rows of
    a node up to which its subtree is completed in one group.
    """
    ready = features if isinstance(features, Prepared) else prepare(features, id_column, categories)
    stages, names, train = _vectors(ready, scaled=False)
    rows = train.select(F.xxhash64(F.col(id_column).cast("string")).alias("key"), F.col(LABEL), "features")
    total = sum(ready.sizes.values())
    balance = tuple(total / (len(ready.sizes) * ready.sizes[label]) for label in (0, 1))
    grown = forest.fit(store(rows, "vectors"), len(names), trees, balance, max_depth, SEED, handed)
    test = stages.transform(ready.test).withColumn("key", F.monotonically_increasing_id())
    test = store(_as_arrays(test).select("key", id_column, LABEL, "features"), "vectors")
    scores = test.join(forest.score(grown, test), "key").select(id_column, LABEL, "probability")
    return Fitted(stages, names, grown.importances, 0.0, store(_with_prediction(scores), "scores"))


def _vectors(ready: Prepared, scaled: bool) -> tuple[PipelineModel, list[str], DataFrame]:
    """Fitted stages, feature names, and the training rows with class weights and ``features`` as an array."""
    rows = sum(ready.sizes.values())
    train = with_balance(ready.train, ready.sizes)
    stages = Pipeline(stages=preprocessing(ready.numbers, ready.listed, rows if scaled else None)).fit(train)
    return stages, feature_names(stages, ready.numbers, ready.listed), _as_arrays(stages.transform(train))


def _as_arrays(rows: DataFrame) -> DataFrame:
    return rows.withColumn("features", vector_to_array("features"))


def _with_prediction(scores: DataFrame) -> DataFrame:
    return scores.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


def prepare(features: DataFrame, id_column: str, categories: list[str]) -> Prepared:
    """Store the feature rows once, typed, and split them."""
    numbers, listed = column_kinds(features, id_column, categories)
    typed = with_missing_level(numeric(features, numbers), listed)
    train, test = split(store(typed, "features"), id_column)
    return Prepared(id_column, numbers, listed, train, test, class_sizes(train))


def preprocessing(numbers: list[str], listed: list[str], rows: int | None) -> list:
    """Stages up to the feature vector; numbers are standardised if ``rows`` is given.

    Missing numbers take the training mean. A level unseen in training becomes zeros; missing
    categories have been given a level of their own.
    MLlib scales by the sample deviation; the factor turns it into the population one.
    """
    filled = [f"{name}_filled" for name in numbers]
    indexed = [f"{name}_index" for name in listed]
    encoded = [f"{name}_levels" for name in listed]
    stages: list = [
        Imputer(strategy="mean", inputCols=numbers, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="numbers"),
    ]
    if rows is not None:
        factor = math.sqrt(rows / (rows - 1))
        stages += [
            StandardScaler(withMean=True, inputCol="numbers", outputCol="centred"),
            ElementwiseProduct(
                scalingVec=Vectors.dense([factor] * len(numbers)),
                inputCol="centred",
                outputCol="scaled",
            ),
        ]
    vector = ["numbers" if rows is None else "scaled"]
    if listed:
        stages += [
            StringIndexer(
                inputCols=listed,
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        ]
    return [*stages, VectorAssembler(inputCols=vector + encoded, outputCol="features")]


def feature_names(model: PipelineModel, numbers: list[str], listed: list[str]) -> list[str]:
    levels = [s.labelsArray for s in model.stages if hasattr(s, "labelsArray")]
    names = list(numbers)
    for column, labels in zip(listed, levels[0] if levels else []):
        names += [f"{column}_{label}" for label in labels]
    return names


def coefficients(fitted: Fitted, top: int = 12) -> DataFrame:
    """The largest coefficients by absolute value; one number per feature."""
    return _top(fitted, "coefficient", top)


def importances(fitted: Fitted, top: int = 12) -> DataFrame:
    return _top(fitted, "importance", top)


def _top(fitted: Fitted, name: str, top: int) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(fitted.feature_names, fitted.weights, strict=True)]
    table = fitted.scores.sparkSession.createDataFrame(rows, f"feature string, {name} double")
    return table.orderBy(F.desc(F.abs(name)), "feature").limit(top)
