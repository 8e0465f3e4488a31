"""Toxicity: a linear classifier whose score must not change when identity terms are swapped."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.text import map_text
from orderlens.operators.storage import store

#: Words that name groups; each is swapped for every other word of its row.
IDENTITY = [
    ["women", "men"],
    ["woman", "man"],
    ["girl", "boy"],
    ["gay", "straight", "lesbian", "bisexual", "transgender"],
    ["black", "white", "asian", "latino", "african", "european"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["immigrant", "citizen", "refugee"],
    ["disabled", "deaf", "blind"],
    ["old", "young"],
]
GROUP = {w: row for row in IDENTITY for w in row}
PREFIXES = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    """Different words in lower case, and their first four, five and six letters (marked by a star)."""
    words = set(_WORD.findall((text or "").lower()))
    out = set(words)
    for n in PREFIXES:
        out.update([w[:n] + "*" for w in words if len(w) > n])
    return out


def swapped(found: set[str]) -> set[str] | None:
    """The features of the same text with its identity terms replaced by others; None without any."""
    terms = found & GROUP.keys()
    if not terms:
        return None
    out = set(found)
    for w in terms:
        row = GROUP[w]
        other = row[(row.index(w) + 1) % len(row)]
        for x, change in ((w, out.discard), (other, out.add)):
            change(x)
            for n in PREFIXES:
                if len(x) > n:
                    change(x[:n] + "*")
    return out


@dataclass
class Model:
    """Weights of features; a text's score is the logistic function of their sum."""

    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, found: set[str]) -> float:
        z = self.bias + sum(map(self.weights.__getitem__, found & self.weights.keys()))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def sample_of_labels(labels: DataFrame, rows: int) -> DataFrame:
    """Up to ``rows`` labelled ids, each class up to half, chosen by a hash; ties of an id: the higher label."""
    one = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id")
    one = one.agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    half = [one.filter(F.col("toxic") == y).orderBy(order, "doc_id").limit(rows // 2) for y in (0, 1)]
    return half[0].unionByName(half[1])


def _useful(rows: DataFrame, classes: tuple[int, int], most: int, least: int) -> list[str]:
    """Features whose share differs clearly between the classes, the clearest first, and all identity terms."""

    def count(batch: pa.RecordBatch) -> pa.Table:
        n = (Counter(), Counter())
        for y, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
            n[y].update(features(text))
        names = list(n[0].keys() | n[1].keys())
        return pa.table(
            {
                "feature": pa.array(names, pa.string()),
                "clean": pa.array([n[0][x] for x in names], pa.int64()),
                "toxic": pa.array([n[1][x] for x in names], pa.int64()),
            }
        )

    n0, n1 = max(classes[0], 1), max(classes[1], 1)
    p0, p1 = F.col("clean") / n0, F.col("toxic") / n1
    p = (F.col("clean") + F.col("toxic")) / (n0 + n1)
    z = F.abs(p1 - p0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / n0 + 1 / n1))
    found = (
        map_text(rows, count, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("clean") + F.col("toxic") >= least)
        .select("feature", z.alias("z"))
        .filter(F.col("z") > 4)
        .orderBy(F.desc("z"), "feature")
        .limit(most)
    )
    return [r["feature"] for r in found.collect()]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = 20_000,
    most_features: int = 8_192,
    least_documents: int = 5,
    swap_penalty: float = 1.0,
    shrink: float = 1e-4,
) -> Model:
    """Fit on a sample of at most ``rows`` labelled documents, ``most_features`` features.

    The loss is the logistic loss of the labels plus ``swap_penalty`` times the squared change of the
    score of each text that names a group when these names are swapped, plus a small square penalty.
    Without labels of both classes every text gets the share of toxic labels (a half without any).
    """
    chosen = F.broadcast(sample_of_labels(labels, rows))  # at most ``rows`` rows
    own = store(docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic"), "labelled")
    counted = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    classes = counted.get(0, 0), counted.get(1, 0)
    if not all(classes):
        share = (classes[1] + 0.5) / (sum(classes) + 1)
        return Model(math.log(share / (1 - share)))
    names = _useful(own, classes, most_features, least_documents)
    terms = {x for w in GROUP for x in features(w)}
    column = {n: k for k, n in enumerate(dict.fromkeys([*names, *sorted(terms)]))}

    def locate(batch: pa.RecordBatch) -> pa.Table:
        plain, other = [], []
        for text in batch.column("text").to_pylist():
            found = features(text)
            change = swapped(found)
            plain.append([column[x] for x in found & column.keys()])
            other.append(None if change is None else [column[x] for x in change & column.keys()])
        kind = pa.list_(pa.int32())
        return pa.table({"toxic": batch.column("toxic"), "x": pa.array(plain, kind), "swap": pa.array(other, kind)})

    # Positions of the chosen features only: at most ``rows`` short lists.
    data = map_text(own, locate, "toxic int, x array<int>, swap array<int>").collect()
    data.sort(key=lambda r: (r["toxic"], r["x"], r["swap"] or []))  # the fit must not depend on row order
    y = np.array([r["toxic"] for r in data], dtype=float)
    pairs = [i for i, r in enumerate(data) if r["swap"] is not None]
    bias, w = descend(
        _sparse([r["x"] for r in data]),
        y,
        np.array(pairs, dtype=int),
        _sparse([data[i]["swap"] for i in pairs]),
        len(column),
        swap_penalty,
        shrink,
    )
    return Model(float(bias), {n: float(w[k]) for n, k in column.items() if abs(w[k]) > 1e-6})


def _sparse(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray, int]:
    sizes = np.array([len(x) for x in lists], dtype=int)
    flat = np.array([k for x in lists for k in x], dtype=int)
    return np.repeat(np.arange(len(lists)), sizes), flat, len(lists)


def descend(x, y, pairs, swap, columns, swap_penalty, shrink, steps=400, rate=0.05):
    """Adam on the penalised loss; classes weigh the same."""

    def times(matrix, w):
        rows, cols, n = matrix
        return np.bincount(rows, w[cols], n)

    def back(matrix, g):
        rows, cols, _ = matrix
        return np.bincount(cols, g[rows], columns)

    weight = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    w, b = np.zeros(columns), 0.0
    m, v = np.zeros(columns + 1), np.zeros(columns + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(times(x, w) + b, -30, 30)))
        g = weight * (p - y) / len(y)
        grad, grad_b = back(x, g) + shrink * w, g.sum()
        if len(pairs):
            q = 1 / (1 + np.exp(-np.clip(times(swap, w) + b, -30, 30)))
            change = p[pairs] - q
            mine = np.zeros(len(y))
            mine[pairs] = 2 * swap_penalty / len(pairs) * change * (p * (1 - p))[pairs]
            theirs = -2 * swap_penalty / len(pairs) * change * q * (1 - q)
            grad += back(x, mine) + back(swap, theirs)
            grad_b += mine.sum() + theirs.sum()
        full = np.append(grad, grad_b)
        m = 0.9 * m + 0.1 * full
        v = 0.999 * v + 0.001 * full * full
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w -= step[:-1]
        b -= step[-1]
    return b, w


def score(docs: DataFrame, model: Model, extra: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns in ``extra`` and ``score`` for every row; the score depends on the text alone.

    Null and empty texts have no features: the score is that of the bias. Repeated rows get equal scores;
    null ids stay. An empty table gives no rows.
    """
    rows = docs.select("doc_id", *extra, "text")
    keep = ["doc_id", *extra]

    def rate(batch: pa.RecordBatch) -> pa.Table:
        scores = [model.score(features(t)) for t in batch.column("text").to_pylist()]
        return pa.table({k: batch.column(k) for k in keep} | {"score": pa.array(scores, pa.float64())})

    kinds = dict(rows.dtypes)
    return map_text(rows, rate, "".join(f"`{k}` {kinds[k]}, " for k in keep) + "score double")


def accepted(docs: DataFrame, model: Model, limit: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``limit``."""

    def keep(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        low = [model.score(features(t)) < limit for t in batch.column("text").to_pylist()]
        return [batch.filter(pa.array(low, pa.bool_()))]

    return map_text(docs, keep, docs.schema)
