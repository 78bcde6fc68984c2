"""Batch gradient descent for one logistic unit with a squared-error objective.

The gradient is mean((p - y) * p * (1 - p) * x). Only the weight vector and one gradient per step reach the
driver; every step is one aggregation over the cached points.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Callback = Callable[[int, list[float], list[float]], None]


def _net(weights: Sequence[float], features: Sequence[Column]) -> Column:
    total = F.lit(float(weights[0])) * features[0]
    for w, x in zip(weights[1:], features[1:]):
        total = total + F.lit(float(w)) * x
    return total


def logistic(weights: Sequence[float], features: Sequence[Column]) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_net(weights, features)))


def _design(columns: Sequence[str], add_intercept: bool) -> list[Column]:
    return [F.col(c).cast("double") for c in columns] + ([F.lit(1.0)] if add_intercept else [])


def fit(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    lr: float = 0.1,
    add_intercept: bool = True,
    w: Sequence[float] | None = None,
    max_iter: int = 100,
    tol: float | None = None,
    callback: Callback | None = None,
    seed: int = 0,
) -> list[float]:
    """Weights after max_iter steps, the intercept last. Without `w`, starts at seeded values in [-1, 1].

    `tol` ends early once the mean absolute gradient falls below it; it is off by default.
    """
    features = _design(columns, add_intercept)
    if w is None:
        rng = random.Random(seed)
        w = [rng.uniform(-1.0, 1.0) for _ in features]
    weights = [float(x) for x in w]
    if len(weights) != len(features):
        raise ValueError(f"{len(features)} weights needed, got {len(weights)}")
    points = df.select(*columns, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for step in range(max_iter):
            p = logistic(weights, features)
            slope = (p - F.col(label)) * p * (1 - p)
            row = points.select(slope.alias("_s"), *columns).agg(*[F.avg(F.col("_s") * x) for x in features]).first()
            grad = list(row)
            if any(g is None for g in grad):
                raise ValueError("no rows to fit")
            if callback is not None:
                callback(step, list(weights), grad)
            if tol is not None and sum(map(abs, grad)) / len(grad) < tol:
                break
            weights = [x - lr * g for x, g in zip(weights, grad)]
    finally:
        points.unpersist()
    return weights


def fit_history(df: DataFrame, columns: Sequence[str], label: str, emit_step: float | None = None, **options) -> DataFrame:
    """(step, w, grad, mean_abs_grad, grad_sum, emitted) per iteration of `fit`.

    `grad_sum` adds up the mean absolute gradients since the last emitted step; a step is emitted once the sum
    passes `emit_step`, and the sum then starts again at zero.
    """
    rows: list[tuple] = []
    state = {"sum": 0.0}

    def record(step: int, weights: list[float], grad: list[float]) -> None:
        size = sum(map(abs, grad)) / len(grad)
        state["sum"] += size
        emitted = emit_step is not None and state["sum"] > emit_step
        rows.append((step, weights, [float(g) for g in grad], size, state["sum"], emitted))
        if emitted:
            state["sum"] = 0.0

    fit(df, columns, label, callback=record, **options)
    return df.sparkSession.createDataFrame(
        rows,
        "step bigint, w array<double>, grad array<double>, mean_abs_grad double, grad_sum double, emitted boolean",
    )


def predict(
    df: DataFrame, columns: Sequence[str], weights: Sequence[float], add_intercept: bool = True
) -> DataFrame:
    """Adds `probability` and `prediction` (1 above one half)."""
    p = logistic(weights, _design(columns, add_intercept))
    return df.withColumn("probability", p).withColumn(
        "prediction", F.when(F.col("probability") > 0.5, 1).otherwise(0).cast("bigint")
    )


def boundary(weights: Sequence[float]) -> tuple[float, float]:
    """Slope and intercept of the line where two features and an intercept give probability one half."""
    a, b, c = weights
    return -a / b, -c / b
