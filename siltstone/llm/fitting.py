"""Bounded samples for fitting, and small numpy helpers that classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounded_sample(df: DataFrame, key: Column, most: int) -> DataFrame:
    """About ``most`` rows, chosen by a hash of ``key``; all rows if there are fewer.

    The rows of ``key`` values that share a hash stay or go together, so a sample is the
    same in every run. One count decides the rate.
    """
    return df.filter(in_sample(df, key, most))


def in_sample(df: DataFrame, key: Column, most: int) -> Column:
    """Whether a row of ``df`` is in its ``bounded_sample``."""
    rows = df.count()
    if rows <= most:
        return F.lit(True)
    scale = 1 << 31
    return F.pmod(F.xxhash64(F.lit(11), key), F.lit(scale)) < int(scale * most / rows)


def remainder(id_col: str, modulus: int) -> Column:
    """CRC-32 of the id written as text, modulo; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(
    x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25, number: np.ndarray | None = None
) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the last is the intercept.

    A row stands for ``number`` equal ones.
    """
    number = np.ones(len(x)) if number is None else number
    full = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(full.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = sigmoid(full @ w)
        gradient = full.T @ ((p - y) * number) + penalty * w
        hessian = (full * ((p * (1 - p) + 1e-6) * number)[:, None]).T @ full + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def calibration(logit: np.ndarray, y: np.ndarray, number: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and intercept that turn scores into probabilities; the slope is positive."""
    if len(y) == 0 or y.min() == y.max():
        return 1.0, 0.0
    number = np.ones(len(y)) if number is None else number
    mean = np.average(logit, weights=number)
    scale = max(float(np.sqrt(np.average((logit - mean) ** 2, weights=number))), 1e-6)
    slope, shift = logistic(logit[:, None] / scale, y, ridge=0.05, number=number)
    return max(float(slope) / scale, 1e-3), float(shift)


def best_threshold(
    p: np.ndarray, y: np.ndarray, fallback: float = 0.5, number: np.ndarray | None = None
) -> float:
    """Middle of the widest stretch of thresholds with the fewest errors."""
    if len(y) == 0 or y.min() == y.max():
        return fallback
    grid = np.arange(0.05, 0.96, 0.01)
    number = np.ones(len(y), np.int64) if number is None else number
    errors = np.array([number[(p >= t) != (y > 0)].sum() for t in grid])
    good = np.flatnonzero(errors == errors.min())
    runs = np.split(good, np.flatnonzero(np.diff(good) > 1) + 1)
    widest = max(runs, key=len)
    return float(grid[widest].mean())
