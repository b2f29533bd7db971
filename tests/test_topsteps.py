"""Top-k as a step function against counting at every second."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepool.operators import topsteps


def brute(rows, k, window):
    """(tick, rank, key, n) wherever the list of the k largest changes."""
    at = {}
    for key, t in rows:
        at.setdefault(t, Counter())[key] += 1
    now, last, out = Counter(), [], []
    for t in range(min(at), max(at) + window + 1):
        now.update(at.get(t, {}))
        now.subtract(at.get(t - window, {}))
        best = sorted(((-n, key is not None, key or "", key) for key, n in now.items() if n > 0))[:k]
        best = [(i, key, -n) for i, (n, _, _, key) in enumerate(best, 1)]
        if best != last:
            out += [(t, *e) for e in best] or [(t, 0, None, 0)]
        last = best
    return sorted(out, key=str)


def steps(spark, rows, k, window, **more):
    df = spark.createDataFrame([(key, t) for key, t in rows], "key string, t long").select("key", F.timestamp_seconds("t").alias("ts"))
    return sorted(map(tuple, topsteps.top_k_steps(df, "key", k, "ts", f"{window} seconds", **more).collect()), key=str)


def dense(n_keys, n, seconds, seed):
    """Heavy and light keys, a burst, a quiet spell, a NULL key."""
    rng = random.Random(seed)
    keys = [f"k{i:03d}" for i in range(n_keys)] + [None]
    weights = [1 / (i + 1) for i in range(len(keys))]
    start = 1_700_000_000
    rows = [(key, start + rng.randrange(seconds)) for key in rng.choices(keys, weights, k=n)]
    rows += [("burst", start + seconds // 2 + rng.randrange(5)) for _ in range(n // 20)]
    return [(key, t) for key, t in rows if not start + seconds // 4 < t < start + seconds // 3]


@pytest.mark.parametrize("segment", [None, "7 seconds", "40 seconds", "100 seconds"])
def test_every_second(spark, segment):
    rows = dense(60, 3000, 200, 1)
    assert steps(spark, rows, 5, 40, segment=segment) == brute(rows, 5, 40)


def test_few_and_equal_keys(spark):
    rows = [(f"k{i}", 1_700_000_000 + i % 3) for i in range(30)]  # all equal: only the order of keys tells
    assert steps(spark, rows, 4, 10) == brute(rows, 4, 10)
    assert steps(spark, rows[:2], 4, 10) == brute(rows[:2], 4, 10)


def test_no_rows(spark):
    assert steps(spark, [], 4, 10) == []


def test_amounts(spark):
    """Stored partial counts give what their rows give."""
    rows = dense(20, 1000, 100, 2)
    partial = spark.createDataFrame([(key, t, n) for (key, t), n in Counter(rows).items()], "key string, t long, n long").select(
        "key", "n", F.timestamp_seconds("t").alias("ts"))
    got = topsteps.top_k_steps(partial, "key", 3, "ts", "30 seconds", amount=F.col("n"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 3, 30)


def test_plan(spark):
    """Only limits and survivors are ranked; nothing leaves the JVM."""
    rows = dense(200, 20_000, 120, 3)
    df = spark.createDataFrame(rows, "key string, t long").select("key", F.timestamp_seconds("t").alias("ts"))
    got = topsteps.top_k_steps(df, "key", 5, "ts", "60 seconds")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and plan.count("WindowGroupLimit") >= 2
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 5, 60)
