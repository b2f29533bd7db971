"""Sessions as keyed state: timers, late rows, restarts, salts and the snapshot read from the state store."""

import pytest
from pyspark.sql import functions as F

from tidepool.operators import sessions
from tidepool.session import shared_dir
from tidepool.streaming import runners
from tidepool.streaming.session_state import SessionStateJob
from tidepool.streaming.sources import table_stream

START = 1_700_000_000
SCHEMA = "ip string, url string, event_id long, ts timestamp"


def write(spark, path, rows):
    df = spark.createDataFrame([(ip, url, i, START + t) for ip, url, i, t in rows], "ip string, url string, event_id long, at long")
    df.select("ip", "url", "event_id", F.timestamp_seconds("at").alias("ts")).coalesce(1).write.mode("append").parquet(path)


def requests():
    """A client that never rests, one with breaks, one that comes once, one without a name."""
    rows = [("busy", t) for t in range(0, 20_000, 300)] + [(None, t) for t in range(0, 20_000, 4000)] + [("once", 9_000)]
    rows += [("breaks", t) for s in (100, 5_000, 12_000) for t in range(s, s + 1_500, 100)]
    return [(ip, f"/{i}", i, t) for i, (ip, t) in enumerate(sorted(rows, key=lambda r: (r[1], r[0] or "")))]


def parts(rows, n, order):
    size = -(-len(rows) // n)
    return [rows[i * size:(i + 1) * size] for i in order]


def show(df):
    return sorted(map(tuple, df.collect()), key=str)


def expected(spark, path):
    return sessions.gap_first_clicks(sessions.second_parts(spark.read.schema(SCHEMA).parquet(path)))


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4, 5), (5, 0, 3, 1, 4, 2)], ids=["in-order", "shuffled"])
@pytest.mark.parametrize("salts", [1, 3])
def test_any_order(spark, order, salts):
    path = shared_dir(spark, "state-visits")
    for part in parts(requests(), 6, order):
        write(spark, path, part)
    job = SessionStateJob(shared_dir(spark, "state-job"), salts=salts, watermark="1 minute")
    runners.drain(job.start(table_stream(spark, path, SCHEMA, 1), available_now=True))
    assert show(job.sessions(spark)) == show(expected(spark, path))
    snapshot = sessions.open_sessions(sessions.second_parts(spark.read.schema(SCHEMA).parquet(path)))
    assert show(job.snapshot(spark)) == show(snapshot)
    done = job.rows(spark, job.committed(spark))
    assert done.where("kind = 'closed'").count() > 0  # timers have fired
    late = job.late_requests(spark)
    assert late == 0 if order[0] == 0 else late > 0
    assert done.agg(F.sum("requests")).first()[0] + job.open_pieces(spark, job.committed(spark)).agg(F.sum("requests")).first()[0] == len(requests())


def test_state_holds_open_sessions_only(spark):
    path, job = shared_dir(spark, "state-visits"), SessionStateJob(shared_dir(spark, "state-job"), watermark="0 seconds")
    for part in parts(requests(), 6, range(6)):
        write(spark, path, part)
        runners.drain(job.start(table_stream(spark, path, SCHEMA, 1), available_now=True))  # each time a restart
        held = job.open_pieces(spark, job.committed(spark)).collect()
        assert all(len(r.click_us) <= 10 for r in held)
        read = [r for r in requests() if r[3] <= part[-1][3]]
        closed_for_long = {r[0] for r in read} - {r[0] for r in read if r[3] > part[0][3] - 1800 - 600}
        assert not closed_for_long & {r.key for r in held}
    assert show(job.sessions(spark)) == show(expected(spark, path))


def test_snapshot_after_every_batch(spark):
    path, job, seen = shared_dir(spark, "state-visits"), SessionStateJob(shared_dir(spark, "state-job"), watermark="1 minute"), {}
    done = []
    for part in parts(requests(), 4, range(4)):
        write(spark, path, part)
        done += part
        runners.drain(job.start(table_stream(spark, path, SCHEMA, 1), available_now=True,
                                on_batch=lambda df, batch_id: seen.update({batch_id: {(r.ip, r.start_us, r.requests) for r in df.collect()}})))
        last = max(r[3] for r in done)
        df = spark.createDataFrame([(ip, url, i, START + t) for ip, url, i, t in done], "ip string, url string, event_id long, at long")
        visits = df.select("ip", "url", "event_id", F.timestamp_seconds("at").alias("ts"))
        open_now = {(r.ip, r.start_us, r.requests) for r in sessions.merge_gap_sessions(sessions.second_parts(visits)).where(
            F.col("end_us") > (START + last) * 1_000_000).collect()}
        assert open_now <= seen[max(seen)]  # sessions that the watermark has not reached yet may be there as well
