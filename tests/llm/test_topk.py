"""Exact top-k search against brute force, with ties, copies, broken vectors and large numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import topk


def brute(rows, every, k, scale=256):
    def whole(v):
        ok = v is not None and all(x is not None and math.isfinite(x) for x in v)
        return [math.floor(scale * x) for x in v] if ok else None

    good = [(i, whole(v)) for i, v in rows if whole(v) is not None]
    out = []
    for n, (i, v) in enumerate(good):
        if i is None or i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w, strict=False)), j is None, j or 0, j) for m, (j, w) in enumerate(good) if m != n]
        out += [(i, rank, j, -s) for rank, (s, _, _, j) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def found(df, *args, **more):
    return sorted((tuple(r) for r in topk.search(df, *args, **more).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [(i, [rng.gauss(0, 0.1) for _ in range(7)]) for i in range(150)]
    out += [(i, list(out[7][1])) for i in range(150, 190)]  # copies, ties
    out += [(200, [0.0] * 7), (205, [-x for x in out[7][1]]), (10, out[3][1]), (10, out[10][1]), (None, out[7][1]), (None, None)]
    out += [(210, None), (215, [1.0, None]), (220, [float("nan")] * 7), (225, [float("inf")] * 7), (230, []), (235, [0.5, -0.5])]
    return out


@pytest.mark.parametrize("k", [1, 5, 400])
def test_brute_force(spark, rows, k, monkeypatch):
    monkeypatch.setattr(topk, "SLAB", 16)  # many cells
    monkeypatch.setattr(topk, "RANGE", 64)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("clash") for c in ("c", "q", "v", "id", "rank", "score", "ids", "block")})
    assert found(df, 5, k) == brute(rows, 5, k)


def test_empty_and_few(spark):
    df = spark.createDataFrame([(0, [0.5, 0.25]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert found(df, 1, 5) == [(0, 1, 1, 256 * 128 + 256 * 64), (1, 1, 0, 256 * 128 + 256 * 64)]
    assert topk.search(df.where("false"), 1, 5).count() == 0
    assert topk.search(df.where("vec_id = 1"), 2, 5).count() == 0


def test_large_numbers():
    big = np.array([[2**40, -(2**40)], [3, 5]])
    with pytest.raises(OverflowError):
        topk.inner_products(big, big)
    rng = np.random.default_rng(0)
    a, b = rng.integers(-(2**28), 2**28, (5, 6)), rng.integers(-(2**28), 2**28, (7, 6))
    want = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]
    assert topk.inner_products(a, b).tolist() == want
