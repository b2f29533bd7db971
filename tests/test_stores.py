"""Tiered parts, running totals, the tailing source, the committing sink, seeding and stable moments."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.operators import kmeans, linreg, windows
from tidepool.session import shared_dir
from tidepool.streaming import datasources, files, runners, sinks, tiers


def local(path):
    return path.removeprefix("file://")


# -------------------------------------------------------------------- tiers
def test_files_per_batch_stay_few():
    """10,000 batches of a second each: a window's reader opens the window's runs, all others grow with the logarithm."""
    runs, fan, window, most, live = [], 32, 300, 0, 0
    for batch in range(10_000):
        runs.append({"name": f"run-{batch}", "level": 0, "first": batch, "last": batch, "lo": batch, "hi": batch})
        while merged := tiers.due_merge(runs, batch, fan, batch - window):
            runs = tiers.with_merged(runs, merged, f"run-{merged[0]['first']}-{merged[-1]['last']}")
        covered = sorted((r["first"], r["last"]) for r in runs)
        if batch % 500 == 0:
            assert [b for a, z in covered for b in range(a, z + 1)] == list(range(batch + 1))
        most, live = max(most, sum(r["hi"] > batch - window for r in runs)), max(live, len(runs))
    assert most <= window and live <= window + 3 * fan


def test_tiered_counts(spark):
    base = shared_dir(spark, "tiers")
    sink = sinks.TieredTickCounts(base, "k", "ts", window_s=5, fan=3)
    rows = [(["a", "b", None][i % 3], 1_700_000_000 + i // 2) for i in range(60)]

    def frame(part):
        return spark.createDataFrame(part, "k string, t long").select("k", F.timestamp_seconds("t").alias("ts"))

    for batch in range(12):
        sink(frame(rows[batch * 5:batch * 5 + 5]), batch)
        sink(frame(rows[batch * 5:batch * 5 + 5]), batch)  # a replay
    sink(frame([]), 12)
    want = sorted(map(str, windows.sliding_counts(frame(rows), "k", "ts", "5 seconds").collect()))
    assert sorted(map(str, sink.sliding(spark, "5 seconds").select("k", "tick", "n").collect())) == want
    kept = {r["name"] for r in sink.parts.runs_since(spark)}
    assert len(kept) < 12 and any(r["level"] > 0 for r in sink.parts.runs_since(spark))
    left = set(files.read_json(spark, f"{base}/manifest.json")["left"])
    assert {n for n in os.listdir(local(base)) if n.startswith("run-")} == kept | (left & set(os.listdir(local(base))))
    last = 1_700_000_000 + 29
    assert len(sink.parts.runs_since(spark, last - 5)) <= 4
    assert sinks.TieredTickCounts(shared_dir(spark, "no-tiers"), "k").read(spark).count() == 0


def test_running_totals(spark):
    path = shared_dir(spark, "totals") + "/t.json"
    totals = files.RunningTotals(spark, path, 2)
    totals.add(0, [5, 1])
    totals.add(1, [7, 1])
    totals.add(1, [2, 1])  # a replay
    totals.add(0, [9, 9])  # counted long ago
    again = files.RunningTotals(spark, path, 2)
    assert again.after == [7, 2] and again.upto(1) == [5, 1] and again.upto(2) == [7, 2]


# --------------------------------------------------------- tail and commits
def lines_of(spark, path, base, split=datasources.SPLIT):
    """What a query over the growing files gives in one more run."""
    out = f"{base}/out"
    run = runners.start_foreach_batch(datasources.tail_lines(spark, path, split), lambda df, i: df.write.mode("overwrite").parquet(
        f"{out}/batch_id={i}"), "tail", checkpoint=f"{base}/checkpoint", available_now=True)
    runners.drain(run)
    return sorted((os.path.basename(r.file), r.offset, r.line) for r in spark.read.parquet(out).collect())


@pytest.mark.parametrize("split", [7, 64 << 20])
def test_tail_goes_on_in_the_middle_of_a_file(spark, split):
    path, base = local(shared_dir(spark, "tail-src")), shared_dir(spark, "tail")
    os.makedirs(path)

    def add(name, raw):
        with open(f"{path}/{name}", "ab") as f:
            f.write(raw)

    add("a.log", "eins\r\nzwei ü\n\nhal".encode())
    assert [x[2] for x in lines_of(spark, path, base, split)] == ["eins", "zwei ü", ""]
    add("a.log", b"f\nvier\n")
    add("b.log", b"new\nunfinished")
    add("_hidden", b"no\n")
    want = [("a.log", 0, "eins"), ("a.log", 6, "zwei ü"), ("a.log", 14, ""), ("a.log", 15, "half"), ("a.log", 20, "vier"), ("b.log", 0, "new")]
    assert lines_of(spark, path, base, split) == want
    assert lines_of(spark, path, base, split) == want  # nothing new, nothing again


def test_committed_rows(spark):
    path = shared_dir(spark, "committed")
    schema = spark.createDataFrame([], "id long, name string").schema
    writer = datasources.RowsWriter(path, schema)
    first = [writer.write(iter([(1, "a"), (2, None)])), writer.write(iter([]))]
    assert datasources.read_committed(spark, path, schema).count() == 0  # not committed yet
    writer.commit(first, 0)
    writer.commit([writer.write(iter([(3, "c")]))], 1)
    writer.commit([writer.write(iter([(3, "c")])), None], 1)  # a replay
    writer.abort([writer.write(iter([(9, "z")]))], 2)
    assert sorted(map(tuple, datasources.read_committed(spark, path, schema).collect())) == [(1, "a"), (2, None), (3, "c")]
    named = {f for c in os.listdir(local(f"{path}/commits")) for f in json.load(open(local(f"{path}/commits/{c}")))["files"]}
    assert {f"data/{n}" for n in os.listdir(local(f"{path}/data"))} == named


# ------------------------------------------------------------------- models
def test_spread_centres(spark):
    """Groups far apart and of different scales, which centres near zero would all miss."""
    rng = np.random.default_rng(1)
    means = np.array([[160_000, 20], [54_000, 50], [112_000, 63], [192_000, 59], [56_000, 34]])
    points = np.concatenate([m + rng.normal(0, [3000, 2], (200, 2)) for m in means])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(points)], "id long, x array<double>")
    centres = kmeans.spread_centres(df, "x", "id", 5)
    assert centres == kmeans.spread_centres(df.repartition(7), "x", "id", 5) and len(centres) == 5
    got = kmeans.cost(df, "x", centres).first()["cost"]
    nearest = ((points[:, None] - np.array(centres)) ** 2).sum(axis=2).min(axis=1)
    assert got == pytest.approx(nearest.sum())
    best = sum(((points[i * 200:i * 200 + 200] - points[i * 200:i * 200 + 200].mean(axis=0)) ** 2).sum() for i in range(5))
    assert got < 1.2 * best
    assert kmeans.spread_centres(df.where("false"), "x", "id", 5) == []
    assert kmeans.spread_centres(df.where("id = 3"), "x", "id", 5) == [points[3].tolist()]


def test_moments_far_from_zero(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (2000, 2))
    y = x @ [0.5, -2.0] + 3 + rng.normal(0, 0.1, 2000)
    far = x + 1e9
    df = spark.createDataFrame([(i % 4, *map(float, row), float(v)) for i, (row, v) in enumerate(zip(far, y, strict=True))],
                               "part int, a double, b double, y double")
    exact = far - 1e9  # what the shifted numbers still hold
    want = np.linalg.lstsq(np.column_stack([exact, np.ones(2000)]), y, rcond=None)[0]
    whole = linreg.centred_moments(df, "y", ["a", "b"]).first()
    assert np.allclose(linreg.least_squares(whole, 2)[0], want[:2], rtol=1e-9)
    origin = [1e9, 1e9, 0.0]
    parts = linreg.centred_moments(df, "y", ["a", "b"], ["part"], origin).collect()
    merged = linreg.merged_moments([r.asDict() for r in parts], 2)
    weights, intercept = linreg.least_squares(merged, 2, origin)
    assert merged["n"] == 2000 and np.allclose(weights, want[:2], rtol=1e-9)
    assert intercept == pytest.approx(want[2] - 1e9 * want[:2].sum(), rel=1e-9)
