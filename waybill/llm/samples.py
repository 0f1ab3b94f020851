"""Bounded, repeatable samples of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled(labels: DataFrame, column: str, allowed, per_class: dict[int, int], id_col: str = "doc_id") -> DataFrame:
    """doc_id, label: for each class the first rows in hash order, so at most the sum of ``per_class`` rows."""
    rows = labels.where(allowed & F.col(column).isNotNull() & F.col(id_col).isNotNull()).select(id_col, F.col(column).cast("int").alias("label"))
    picked = None
    for label, most in per_class.items():
        part = rows.where(F.col("label") == label).orderBy(F.xxhash64(F.lit("sample"), id_col), id_col).limit(most)
        picked = part if picked is None else picked.union(part)
    return picked.dropDuplicates([id_col])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic curve through rows of x. Newton's steps; all zero if y has one value only."""
    x = np.asarray(x, float).reshape(len(y), -1)
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(x.shape[1]), 0.0
    centre, scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
    design = np.hstack([(x - centre) / scale, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-9])
    w = np.zeros(design.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) / len(x) + penalty @ w
        hessian = design.T @ (design * (p * (1 - p))[:, None]) / len(x) + penalty + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ centre)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))
