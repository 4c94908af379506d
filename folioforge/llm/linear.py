"""A small logistic regression with L2 penalty, fitted by Newton steps, and helpers for labelled samples."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


PASSING = 2048


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias

    def p(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(x))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, penalty: float = 1.0, steps: int = 25) -> Logistic:
    """y in [0, 1]. With no rows, or rows of one class, the model gives (nearly) the smoothed share of that class everywhere.

    Rows are standardised in passing, a few thousand at a time, so that x (of any precision) is the only large array.
    """
    n, d = x.shape
    w = np.ones(n) if weight is None else weight.astype(float)
    share = (float((w * y).sum()) + 0.5) / (float(w.sum()) + 1)
    mean = x.mean(0, dtype=float) if n else np.zeros(d)
    scale = x.std(0, dtype=float) if n else np.ones(d)
    scale = np.where(scale < 1e-9, 1.0, scale)
    b = np.zeros(d + 1)
    b[-1] = math.log(share / (1 - share))
    if n and 0 < float((w * y).sum()) < float(w.sum()):
        ridge = np.diag(np.append(np.full(d, penalty), 1e-3))
        centre = np.append(np.zeros(d), b[-1])

        def passing(at: int) -> tuple[slice, np.ndarray]:
            part = slice(at, at + PASSING)
            return part, np.hstack([(x[part] - mean) / scale, np.ones((len(x[part]), 1))])

        def loss(b: np.ndarray) -> float:
            out = float((b - centre) @ ridge @ (b - centre)) / 2
            for at in range(0, n, PASSING):
                part, z = passing(at)
                t = z @ b
                out += float((w[part] * (np.logaddexp(0, t) - y[part] * t)).sum())
            return out

        now = loss(b)
        for _ in range(steps):
            g, h = ridge @ (b - centre), ridge.copy()
            for at in range(0, n, PASSING):
                part, z = passing(at)
                p = sigmoid(z @ b)
                g += z.T @ (w[part] * (p - y[part]))
                h += (z * (w[part] * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z
            step, share = np.linalg.solve(h, g), 1.0
            falls = float(step @ g)
            while (then := loss(b - share * step)) > now - 1e-4 * share * falls and share > 1e-6:
                share /= 2  # a full step may pass the minimum by far
            b, now = b - share * step, min(now, then)
            if falls < 1e-7 * max(1.0, now):
                break
    return Logistic(mean, scale, b[:-1], float(b[-1]))


def platt(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that calibrate logits on held-out rows."""
    m = fit(logit[:, None], y, penalty=1e-2)
    slope = float(m.weights[0] / m.scale[0])
    return max(slope, 0.0), float(m.bias - m.mean[0] * slope) if slope > 0 else m.bias


def folds(keys: np.ndarray, k: int) -> np.ndarray:
    """Fold of each row by a hash of its key, so that repeated rows fall together."""
    h = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return (h % np.uint64(k)).astype(np.int64)


def hashed_share(n: int, bound: int) -> float:
    """Share of n rows whose expected number is at most ``bound``."""
    return min(1.0, bound / n) if n else 1.0


def in_share(column: str, share: float, seed: int):
    """Rows of a fixed pseudo-random share, chosen by the value of a column alone."""
    if share >= 1:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def labels_of(labels: DataFrame, column: str, id_column: str = "doc_id") -> DataFrame:
    """One label per id: rows with a null or with anything but 0 and 1 are left out, and of rows that disagree the larger label counts."""
    return labels.where(F.col(id_column).isNotNull() & F.col(column).isin(0, 1)).groupBy(F.col(id_column).alias("label_id")).agg(F.max(F.col(column)).cast("int").alias("label"))
