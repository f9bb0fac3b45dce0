"""Bounded samples of labelled documents, and one-dimensional calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, allowed: Column, limit: int, id_col: str, text_col: str
) -> DataFrame:
    """``(id, text, label, draw)`` of at most ``limit`` labelled documents, the same ones on every run.

    Rows are drawn by a hash of the id from labels for which ``allowed`` holds; null labels and ids
    are left out, and an id that is labelled twice counts by the rounded mean. Only the drawn ids,
    whose number is bounded, are sent to the tasks that read the texts. ``draw`` is uniform in 0..999.
    """
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & allowed)
        .groupBy(id_col)
        .agg((F.avg(label) >= 0.5).cast("int").alias("label"))
        .withColumn("draw_hash", F.xxhash64(F.lit("draw"), F.col(id_col)))
        .orderBy("draw_hash", id_col)
        .limit(limit)
    )
    texts = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), id_col).select(
        id_col, "text", "label", F.pmod(F.col("draw_hash"), F.lit(1000)).cast("int").alias("draw")
    )


def logistic_fit(features: np.ndarray, target: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, the intercept first.

    Without rows, or with one class only, the weights give the smoothed base rate.
    """
    n = len(target)
    rate = (target.sum() + 1.0) / (n + 2.0)
    weights = np.zeros(features.shape[1] + 1)
    weights[0] = np.log(rate / (1 - rate))
    if n == 0 or target.min() == target.max():
        return weights
    design = np.column_stack([np.ones(n), features])
    penalty = ridge * np.eye(design.shape[1])
    penalty[0, 0] = 1e-9
    for _ in range(steps):
        p = logistic(design @ weights)
        gradient = design.T @ (target - p) - penalty @ weights
        curvature = (design * (p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(curvature, gradient)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def logistic(values: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(values, -40.0, 40.0)))
