"""The ring of ticks in keyed state: equal to the batch step function for any order, late rows and restarts included."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators import windows
from tidepool.session import shared_dir
from tidepool.streaming import runners
from tidepool.streaming.sliding_state import SlidingStateJob
from tidepool.streaming.sources import table_stream

START, SCHEMA = 1_700_000_000, "url string, event_id long, ts timestamp"


def rows():
    rng = random.Random(4)
    out = [(rng.choice(["/a", "/a", "/b", None]), rng.randrange(400)) for _ in range(1200)]
    out += [("/gone", 3), ("/late", 390)] + [("/swap", 10), ("/swap", 40)]  # one goes as the other comes
    return sorted(out, key=lambda r: r[1])


def frame(spark, found):
    df = spark.createDataFrame([(u, i, START + t) for i, (u, t) in enumerate(found)], "url string, event_id long, at long")
    return df.select("url", "event_id", F.timestamp_seconds("at").alias("ts"))


def files(spark, order):
    path, n = shared_dir(spark, "ring-src"), -(-len(rows()) // len(order))
    for q in order:
        frame(spark, rows()[q * n:(q + 1) * n]).coalesce(1).write.mode("append").parquet(path)
    return path


def show(df):
    return sorted(((r.url, r.tick, r.n) for r in df.collect()), key=str)


@pytest.mark.parametrize("salts", [1, 2])
@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4, 5, 6, 7), (7, 0, 5, 2, 1, 6, 4, 3)], ids=["in-order", "shuffled"])
def test_equals_batch(spark, order, salts):
    job = SlidingStateJob(shared_dir(spark, "ring"), "url", window="30 seconds", watermark="5 seconds", salts=salts)
    seen = []
    runners.drain(job.start(table_stream(spark, files(spark, order), SCHEMA, 1), available_now=True, id_col="event_id",
                            on_batch=lambda df, _: seen.extend(df.collect())))
    want = show(windows.sliding_counts(frame(spark, rows()), "url", "ts", "30 seconds"))
    assert show(job.steps(spark)) == want
    late = job.rows(spark, job.committed(spark)).where("kind = 'late'").count()
    assert (late == 0) == (order[0] == 0)
    if salts == 1 and order[0] == 0:  # what the timers gave out on the way was final
        assert seen and {(r.key, r.tick, r.n) for r in seen} <= set(want)
        held = job.state(spark, "slots", job.committed(spark)).select("key.key", "user_map_key.tick").collect()
        assert not any(r.key == "/gone" for r in held) and len(held) <= 4 * (30 + 60)


def test_restart(spark):
    path, job = shared_dir(spark, "ring-src"), SlidingStateJob(shared_dir(spark, "ring"), "url", window="30 seconds", watermark="5 seconds")
    for q in range(4):
        frame(spark, rows()[q * 301:(q + 1) * 301]).coalesce(1).write.mode("append").parquet(path)
        runners.drain(job.start(table_stream(spark, path, SCHEMA, 1), available_now=True))
        want = windows.sliding_counts(frame(spark, rows()[:(q + 1) * 301]), "url", "ts", "30 seconds")
        assert show(job.steps(spark)) == show(want)
