"""Streaming linear regression (ML3, ML4, ML5).

Full-batch gradient descent on least squares only needs the batch's moments:
with x' = [x, 1], G = sum x' x'^T and h = sum x' y, the mean gradient is
(G w - h) / n. So each batch costs ONE distributed aggregate (all batches of a
replay are one ``groupBy(batch)``), and the iterations run on the driver on a
(d+1)^2 matrix, exactly as the row-wise SGD of Spark's streaming regression
with mini-batch fraction 1.0 would compute them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (Spark's streaming regression defaults used by the reference)
STEP_SIZE = 0.1
NUM_ITERATIONS = 50
MINI_BATCH_FRACTION = 1.0
CONVERGENCE_TOL = 0.001
NUM_FEATURES = 1
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment_columns(label, features: list) -> list[Column]:
    """Aggregates for n, G (upper triangle incl. bias) and h; names are stable."""
    y = _col(label).cast("double")
    xs = [_col(f).cast("double") for f in features] + [F.lit(1.0)]
    d = len(xs)
    cols = [F.count(F.lit(1)).alias("n"), F.sum(y * y).alias("yy")]
    for i in range(d):
        cols.append(F.sum(xs[i] * y).alias(f"h_{i}"))
        for j in range(i, d):
            cols.append(F.sum(xs[i] * xs[j]).alias(f"g_{i}_{j}"))
    return cols


def regression_moments(df: DataFrame, label, features: list, by=()) -> DataFrame:
    return df.groupBy(*by).agg(*moment_columns(label, features))


def _matrices(row, d: int):
    g = np.zeros((d, d))
    h = np.zeros(d)
    for i in range(d):
        h[i] = row[f"h_{i}"]
        for j in range(i, d):
            g[i, j] = g[j, i] = row[f"g_{i}_{j}"]
    return float(row["n"]), g, h


def sgd_on_moments(n: float, g: np.ndarray, h: np.ndarray, w0: np.ndarray,
                   step: float = STEP_SIZE, iters: int = NUM_ITERATIONS,
                   tol: float = CONVERGENCE_TOL) -> np.ndarray:
    """Gradient descent with step/sqrt(i) and the relative-change stop rule."""
    w = w0.astype(float).copy()
    if n <= 0:
        return w
    prev = None
    for i in range(1, iters + 1):
        grad = (g @ w - h) / n
        w = w - (step / np.sqrt(i)) * grad
        if prev is not None and np.linalg.norm(prev - w) < tol * max(np.linalg.norm(w), 1.0):
            break
        prev = w.copy()
    return w


def centred_moments(df: DataFrame, label, features: list, by=(), origin=None) -> DataFrame:
    """``n``, the means ``m_i`` (label last) and the central co-moments ``c_i_j`` (sums over the upper triangle).

    Spark merges these pairwise from task to task, so nothing is lost where
    values lie far from zero, as it is in raw sums of squares. Parts that are to
    be merged later need an ``origin`` near their values (of each feature and the
    label, e.g. the means of the first part), as their means are doubles, too.
    """
    xs = [_col(f).cast("double") - float(o) for f, o in zip([*features, label], origin or [0.0] * (len(features) + 1))]
    n = F.count(F.lit(1))
    return df.where(F.greatest(*[x.isNull().cast("int") for x in xs], F.lit(0)) == 0).groupBy(*by).agg(
        n.alias("n"), *[F.avg(x).alias(f"m_{i}") for i, x in enumerate(xs)],
        *[(F.covar_pop(xs[i], xs[j]) * n).alias(f"c_{i}_{j}") for i in range(len(xs)) for j in range(i, len(xs))])


def merged_moments(parts: list[dict], d: int) -> dict:
    """Moments of several parts, e.g. batches, as those of all their rows (``d`` features)."""
    total = {"n": 0, "m": np.zeros(d + 1), "c": np.zeros((d + 1, d + 1))}
    for p in parts:
        n, m, c = _centred(p, d)
        if not n:
            continue
        both, gap = total["n"] + n, m - total["m"]
        total = {"n": both, "m": total["m"] + gap * (n / both),
                 "c": total["c"] + c + np.outer(gap, gap) * (total["n"] * n / both)}
    return total


def _centred(row, d: int) -> tuple[float, np.ndarray, np.ndarray]:
    if isinstance(row, dict) and "m" in row:
        return row["n"], row["m"], row["c"]
    m = np.array([row[f"m_{i}"] or 0.0 for i in range(d + 1)])
    c = np.zeros((d + 1, d + 1))
    for i in range(d + 1):
        for j in range(i, d + 1):
            c[i, j] = c[j, i] = row[f"c_{i}_{j}"] or 0.0
    return float(row["n"]), m, c


def least_squares(row, d: int, origin=None) -> tuple[np.ndarray, float]:
    """Weights and intercept that fit best, from central co-moments with that origin."""
    _, m, c = _centred(row, d)
    weights = np.linalg.lstsq(c[:d, :d], c[:d, d], rcond=None)[0]
    m = m + np.array(origin if origin is not None else [0.0] * (d + 1))
    return weights, float(m[d] - weights @ m[:d])


@dataclass
class StreamingLinearModel:
    """Weights (and intercept, last) carried across batches on the driver.

    ``carry_intercept=False`` restarts the intercept at 1.0 every batch, which
    is what re-running the batch algorithm from the previous weights does.
    """

    weights: np.ndarray
    intercept: float = 0.0
    carry_intercept: bool = True
    step: float = STEP_SIZE
    iters: int = NUM_ITERATIONS
    tol: float = CONVERGENCE_TOL

    @classmethod
    def zeros(cls, d: int = NUM_FEATURES, **kw) -> "StreamingLinearModel":
        return cls(np.zeros(d), **kw)

    def update_from_moments(self, row) -> None:
        d = len(self.weights) + 1
        n, g, h = _matrices(row, d)
        b0 = self.intercept if self.carry_intercept else 1.0
        w = sgd_on_moments(n, g, h, np.append(self.weights, b0), self.step, self.iters, self.tol)
        self.weights, self.intercept = w[:-1], float(w[-1])

    def predict(self, features: list, out: str = "prediction") -> Column:
        expr = F.lit(self.intercept)
        for w, f in zip(self.weights, features):
            expr = expr + F.lit(float(w)) * _col(f).cast("double")
        return expr.alias(out)


def predict_array(features, weights: list, intercept: float) -> Column:
    """ML4 on an ``array<double>`` features column."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    dot = F.aggregate(F.zip_with(_col(features), w, lambda a, b: a * b), F.lit(0.0),
                      lambda acc, x: acc + x)
    return dot + F.lit(float(intercept))
