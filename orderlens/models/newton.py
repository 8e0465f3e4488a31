"""Logistic regression with a quadratic penalty by Newton's method.

A step needs the gradient and the curvature matrix, k * (k + 3) / 2 sums over all rows for k features. Every task
adds up its rows and sends its sums, Spark adds those up, and the driver solves k equations. The optimum is
unique, and some ten passes reach it to the last digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Passes at most, and the change of all coefficients after which they end: the error is its square.
PASSES, ENOUGH = 100, 1e-7


def matrix(batch: pa.RecordBatch, name: str = "features") -> np.ndarray:
    """The vectors of a batch, one a row."""
    lists = batch.column(name)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(lists), -1)


def sums(rows: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted loss, its gradient and its curvature at ``beta`` (the intercept last).

    ``rows``: ``label`` (0 or 1), ``weight``, ``features`` (array of doubles). The rows of a task become one row per cell.
    """
    size = len(beta)
    upper = np.triu_indices(size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + size + len(upper[0]))
        for batch in batches:
            if batch.num_rows:
                x = np.hstack([matrix(batch), np.ones((batch.num_rows, 1))])
                y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
                w = batch.column("weight").to_numpy(zero_copy_only=False)
                z = x @ beta
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                total[0] += w @ (np.logaddexp(0, z) - y * z)
                total[1 : 1 + size] += x.T @ (w * (p - y))
                total[1 + size :] += (x.T @ (x * (w * p * (1 - p))[:, None]))[upper]
        yield pa.RecordBatch.from_pydict({"cell": np.arange(len(total), dtype=np.int32), "value": total})

    found = rows.select("label", "weight", "features").mapInArrow(add, "cell int, value double")
    cells = found.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    total = np.zeros(1 + size + len(upper[0]))
    total[cells.column("cell").to_numpy()] = cells.column("value").to_numpy()
    curvature = np.zeros((size, size))
    curvature[upper] = total[1 + size :]
    curvature = curvature + np.triu(curvature, 1).T
    return total[0], total[1 : 1 + size], curvature


def fit(rows: DataFrame, features: int, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Coefficients and intercept that minimise the weighted loss plus ``penalty`` times half their squared norm.

    The intercept bears no penalty. A step that does not lower the sum is halved.
    """
    strength = np.append(np.full(features, penalty), 0.0)
    beta, step = np.zeros(features + 1), np.zeros(features + 1)
    best = np.inf
    for _ in range(PASSES):
        loss, gradient, curvature = sums(rows, beta + step)
        now = loss + 0.5 * (strength * (beta + step) ** 2).sum()
        if now > best + 1e-9 * abs(best):
            step = step / 2
            continue
        beta, best = beta + step, now
        step = -np.linalg.lstsq(curvature + np.diag(strength), gradient + strength * beta, rcond=None)[0]
        if np.abs(step).max() < ENOUGH:
            break
    return beta[:-1] + step[:-1], float(beta[-1] + step[-1])


def probability(weights: np.ndarray, intercept: float, features: str = "features") -> Column:
    """Probability of class 1 as a row expression."""
    products = F.zip_with(features, F.lit([float(w) for w in weights]), lambda x, w: x * w)
    margin = F.aggregate(products, F.lit(float(intercept)), lambda total, x: total + x)
    return 1 / (1 + F.exp(-margin))
