"""Streaming k-means (ML1, ML2) on DataFrames.

Assignment is a column expression: the k centres travel as one literal
``array<array<double>>`` constant and each row picks the nearest by
squared distance, ties to the lowest index. A batch update is then one
aggregate per cluster with map-side combine; only k rows of sums reach the
driver, which applies the forgetful update

    c' = (c * n * a + sum_x) / (n * a + m),   n' = n * a + m

(``a`` = decay per batch) and splits the largest cluster when one is dying,
as Spark's streaming k-means does.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (the reference's model settings) ---------------------------
K = 5
DECAY = 1.0
DIM = 2
INITIAL_WEIGHT = 0.0
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def centres_literal(centres) -> Column:
    """All centres as one constant, however many there are."""
    text = json.dumps(np.asarray(centres, dtype=float).tolist())
    return F.from_json(F.lit(text), "array<array<double>>")


def squared_distances(features, centres) -> Column:
    feats = _col(features)
    return F.transform(
        centres_literal(centres),
        lambda c: F.aggregate(F.zip_with(c, feats, lambda a, b: (a - b) * (a - b)),
                              F.lit(0.0), lambda acc, x: acc + x))


def nearest_centre(features, centres) -> Column:
    """Index of the closest centre (0-based, ties to the lowest index)."""
    distances = F.array(squared_distances(features, centres))  # computed once, used twice
    at = F.element_at(F.transform(distances, lambda d: F.array_position(d, F.array_min(d))), 1)
    return (at - 1).cast("int")


def cluster_sums(df: DataFrame, features: str, centres) -> DataFrame:
    """``(cluster, m, s_0 .. s_{d-1})``: one row per non-empty cluster."""
    dim = len(centres[0])
    assigned = df.select(nearest_centre(features, centres).alias("cluster"),
                         F.col(features).alias("_x"))
    return assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("m"),
        *[F.sum(F.col("_x")[i]).alias(f"s_{i}") for i in range(dim)])


def batch_centres(df: DataFrame, features: str, centres) -> DataFrame:
    """One update from zero-weight centres: the mean of each cluster's points."""
    dim = len(centres[0])
    sums = cluster_sums(df, features, centres)
    return sums.select("cluster", F.col("m").alias("n"),
                       *[(F.col(f"s_{i}") / F.col("m")).alias(f"c_{i}") for i in range(dim)])


@dataclass
class StreamingKMeansModel:
    """Centres and weights carried across batches on the driver (O(k*d))."""

    centres: np.ndarray
    weights: np.ndarray
    decay: float = DECAY

    @classmethod
    def random(cls, k: int = K, dim: int = DIM, weight: float = INITIAL_WEIGHT, seed: int = 42,
               decay: float = DECAY) -> "StreamingKMeansModel":
        rng = np.random.default_rng(seed)
        return cls(rng.standard_normal((k, dim)), np.full(k, float(weight)), decay)

    @classmethod
    def given(cls, centres, weight: float = INITIAL_WEIGHT, decay: float = DECAY):
        c = np.asarray(centres, dtype=float)
        return cls(c.copy(), np.full(len(c), float(weight)), decay)

    def update_from_sums(self, rows) -> None:
        """Apply one batch given ``(cluster, m, s_0..)`` rows."""
        self.weights = self.weights * self.decay
        for r in rows:
            j, m = int(r["cluster"]), float(r["m"])
            s = np.array([float(r[f"s_{i}"]) for i in range(self.centres.shape[1])])
            w_new = self.weights[j] + m
            lam = m / max(w_new, 1e-16)
            self.centres[j] = (1.0 - lam) * self.centres[j] + (lam / m) * s
            self.weights[j] = w_new
        largest, smallest = int(np.argmax(self.weights)), int(np.argmin(self.weights))
        if self.weights[smallest] < 1e-8 * self.weights[largest]:
            w = (self.weights[largest] + self.weights[smallest]) / 2.0
            self.weights[largest] = self.weights[smallest] = w
            x = self.centres[largest].copy()
            p = 1e-14 * np.maximum(np.abs(x), 1.0)
            self.centres[largest] = x + p
            self.centres[smallest] = x - p

    def train_batch(self, df: DataFrame, features: str) -> None:
        """One micro-batch: a distributed aggregate, k rows back."""
        rows = cluster_sums(df, features, self.centres.tolist()).collect()
        self.update_from_sums(rows)

    def predict(self, df: DataFrame, features: str, out: str = "cluster") -> DataFrame:
        return df.withColumn(out, nearest_centre(features, self.centres.tolist()))

    def as_rows(self, batch_id: int) -> list[tuple]:
        return [(int(batch_id), j, float(self.weights[j]), [float(x) for x in self.centres[j]])
                for j in range(len(self.weights))]


def _uniform(seed: int, turn: int, key: Column) -> Column:
    """A number in [0, 1) for each row, the same whenever it is computed."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), key), F.lit(1 << 52)) / float(1 << 52)


def spread_centres(df: DataFrame, features: str, key, k: int = K, rounds: int = 5, oversample: float = 2.0,
                   seed: int = 42) -> list[list[float]]:
    """``k`` start centres by k-means||, for points that random centres would miss.

    In each round every point becomes a candidate with a probability in
    proportion to its squared distance from the candidates so far; about
    ``oversample * k`` do, so a few rounds of one aggregate and one small
    collect replace k passes. The candidates, weighted by the points nearest to
    them, are then reduced to k on the driver. ``key`` identifies a row: the
    draws are hashes of it, so the same points give the same centres.
    """
    points = df.select(F.col(features).alias("x"), _col(key).alias("key"))
    first = points.orderBy(_uniform(seed, 0, F.col("key")), "key").limit(1).collect()
    if not first:
        return []
    candidates = [list(first[0]["x"])]
    for turn in range(1, rounds + 1):
        far = points.select("x", "key", F.array_min(squared_distances("x", candidates)).alias("d"))
        total = far.agg(F.sum("d")).first()[0]
        if not total:
            break  # every point is a candidate
        chance = oversample * k / total * F.col("d")
        candidates += sorted(list(r["x"]) for r in far.where(_uniform(seed, turn, F.col("key")) < chance).select("x").distinct().collect())
    weights = np.zeros(len(candidates))
    for r in points.groupBy(nearest_centre("x", candidates).alias("c")).count().collect():
        weights[r["c"]] = r["count"]
    return reduced_centres(np.array(candidates, dtype=float), weights, k, seed).tolist()


def reduced_centres(points: np.ndarray, weights: np.ndarray, k: int, seed: int, turns: int = 20) -> np.ndarray:
    """k weighted centres of a few points: seeded far apart, then moved to their means."""
    rng = np.random.default_rng(seed)
    centres = [points[int(weights.argmax())]]
    while len(centres) < min(k, len(points)):
        d = weights * ((points[:, None] - np.array(centres)) ** 2).sum(axis=2).min(axis=1)
        if not d.sum():
            break
        centres.append(points[rng.choice(len(points), p=d / d.sum())])
    out = np.array(centres)
    for _ in range(turns):
        own = ((points[:, None] - out) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([np.average(points[own == j], axis=0, weights=weights[own == j]) if weights[own == j].sum() else out[j]
                          for j in range(len(out))])
        if np.allclose(moved, out):
            break
        out = moved
    return out[np.lexsort(out.T[::-1])]


def cost(df: DataFrame, features: str, centres) -> DataFrame:
    """The sum of squared distances to the nearest centres, as one row."""
    return df.agg(F.sum(F.array_min(squared_distances(features, centres))).alias("cost"))


MODEL_SCHEMA = "batch_id bigint, cluster int, weight double, centre array<double>"


def scaling_stats(df: DataFrame, features: str, dim: int = DIM):
    """Per-dimension mean and population std in ONE aggregate (2*d numbers back).

    The reference clusters raw (income, age) pairs whose scales differ by four
    orders of magnitude; scaling is optional and off by default.
    """
    x = F.col(features)
    row = df.agg(*[F.avg(x[i]).alias(f"m{i}") for i in range(dim)],
                 *[F.stddev_pop(x[i]).alias(f"s{i}") for i in range(dim)]).first()
    mu = [float(row[f"m{i}"]) for i in range(dim)]
    sd = [float(row[f"s{i}"]) if row[f"s{i}"] else 1.0 for i in range(dim)]
    return mu, sd


def apply_scaling(df: DataFrame, features: str, mu, sd, out: str | None = None) -> DataFrame:
    """``(x - mu) / sd`` per dimension; a projection, so it also runs on streams."""
    x = F.col(features)
    scaled = F.array(*[(x[i] - F.lit(m)) / F.lit(s) for i, (m, s) in enumerate(zip(mu, sd))])
    return df.withColumn(out or features, scaled)
