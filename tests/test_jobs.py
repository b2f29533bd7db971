"""Every ready-made job runs on a file stream and agrees with a batch computation."""

import time

from pyspark.sql import functions as F

from tidepool.functions import accesslog as al
from tidepool.functions import text as tx
from tidepool.functions.vectors import parse_labeled_point, parse_vector
from tidepool.plans.streams import _events_stream, _log_stream, ntz_to_instant
from tidepool.session import shared_dir
from tidepool.sources import fixtures as fx
from tidepool.streaming import jobs, runners

from conftest import SF_SMALL


def _collector():
    got = {}
    return got, lambda batch_id, rows: got.__setitem__(batch_id, rows)


def _expected_top(df, key, k=10, window=300):
    last = df.agg(F.max(F.unix_timestamp("ts"))).first()[0]
    sec = F.unix_timestamp("ts")
    top = (df.where((sec > last - window) & (sec <= last)).groupBy(key).count()
             .orderBy(F.desc("count"), F.asc(key)).limit(k).collect())
    return [(r[key], r["count"]) for r in top]


def _statuses(spark):
    ev = _events_stream(spark, SF_SMALL)
    return ev.select(ntz_to_instant("ts").alias("ts"), fx.status_text().alias("text"))


def test_url_counts_job(spark):
    got, cb = _collector()
    runners.drain(jobs.start_url_counts(_log_stream(spark, SF_SMALL), shared_dir(spark, "job-url"),
                                        on_result=cb, available_now=True), 300)
    urls = al.to_strict_urls(fx.logs(spark, SF_SMALL), "line", keep=("ts",))
    assert got[max(got)] == _expected_top(urls, "url")


def test_leak_url_counts_job(spark):
    got, cb = _collector()
    runners.drain(jobs.start_url_counts(_log_stream(spark, SF_SMALL), shared_dir(spark, "job-leak"),
                                        leak=True, on_result=cb, window_s=86400 * 40,
                                        available_now=True), 300)
    assert "()" in [u for u, _ in got[max(got)]]


def test_alarm_job(spark):
    got, cb = _collector()
    runners.drain(jobs.start_alarm(_log_stream(spark, SF_SMALL), shared_dir(spark, "job-alarm"),
                                   on_result=cb, window_s=86400 * 40, available_now=True), 300)
    cls = al.to_status_classes(fx.logs(spark, SF_SMALL), "line")
    s = cls.where("status_class = 'Success'").count()
    f = cls.where("status_class = 'Failure'").count()
    lines = got[max(got)]
    assert lines[0] == f"Total success: {s} Total failure: {f}"
    assert lines[1] in ("Wake somebody up! Something is horribly wrong.", "All systems go.")


def test_batch_sql_and_json_and_row_store_jobs(spark):
    base = shared_dir(spark, "job-sql")
    runners.drain(jobs.start_batch_sql(_log_stream(spark, SF_SMALL), base, available_now=True), 300)
    out = spark.read.parquet(f"{base}/out")
    assert out.agg(F.sum("total")).first()[0] == 1000

    base = shared_dir(spark, "job-json")
    runners.drain(jobs.start_json_requests(_log_stream(spark, SF_SMALL), base, available_now=True), 300)
    assert spark.read.json(f"{base}/requests").count() == 1000

    base = shared_dir(spark, "job-rows")
    q, store = jobs.start_row_store(_log_stream(spark, SF_SMALL), base, format="orc", available_now=True)
    runners.drain(q, 300)
    rows = al.to_rows(fx.logs(spark, SF_SMALL), "line")
    assert store.read(spark).count() == store.rows_written == rows.select("ip", "url").distinct().count()


def test_sessions_job(spark):
    got, cb = _collector()
    base = shared_dir(spark, "job-sessions")
    q = jobs.start_sessions(_log_stream(spark, SF_SMALL), base, on_result=cb, available_now=True)
    runners.drain(q, 300)
    assert got and all(len(r) <= 20 for r in got.values())
    snap = {r["ip"] for r in jobs.session_snapshot(spark, base).collect()}
    visits = al.to_visits(fx.logs(spark, SF_SMALL), "line", keep=("ts",))
    last = visits.agg(F.max("ts")).first()[0]
    assert snap == {r["ip"] for r in visits.where(F.col("ts") > F.lit(last) - F.expr("interval 30 minutes")).collect()}


def test_top_hashtags_and_words_jobs(spark):
    got, cb = _collector()
    runners.drain(jobs.start_top_hashtags(_statuses(spark), shared_dir(spark, "job-tags"),
                                          on_result=cb, available_now=True), 300)
    tags = tx.hashtags(fx.statuses(spark, SF_SMALL), "text", "tag", keep=("ts",))
    assert got[max(got)] == _expected_top(tags, "tag")
    got, cb = _collector()
    runners.drain(jobs.start_top_words(_statuses(spark), shared_dir(spark, "job-words"),
                                       on_result=cb, available_now=True), 300)
    words = tx.content_words(fx.statuses(spark, SF_SMALL), "text", "word", keep=("ts",))
    assert got[max(got)] == _expected_top(words, "word")


def test_save_and_gauges_jobs(spark):
    q, capture = jobs.start_save_statuses(_statuses(spark), shared_dir(spark, "job-save"),
                                          available_now=True)
    runners.drain_capture(q, capture)
    assert capture.done and capture.total == 1000
    got, cb = _collector()
    q, listener = jobs.start_length_gauges(_statuses(spark), shared_dir(spark, "job-gauges"),
                                           on_result=cb, available_now=True)
    runners.drain(q, 300)
    for _ in range(50):  # the listener bus delivers progress events asynchronously
        if got:
            break
        time.sleep(0.2)
    st = fx.statuses(spark, SF_SMALL).select(tx.utf16_length("text").alias("n"))
    total, longest = st.agg(F.sum("n"), F.max("n")).first()
    m = got[min(got)][0]
    assert m == {"counter": 1000, "avg_length": total // 1000, "longest_in_batch": longest}


def test_model_jobs(spark):
    ev = _events_stream(spark, SF_SMALL)
    vec = ev.select(F.concat(F.lit("["), F.col("value").cast("string"), F.lit(","),
                             F.col("user_id").cast("string"), F.lit("]")).alias("line"))
    train = vec.select(parse_vector("line").alias("features"))
    lp = ev.select(F.concat(F.lit("("), (F.col("event_id") % 5).cast("string"), F.lit(",["),
                            F.col("value").cast("string"), F.lit(","), F.col("user_id").cast("string"),
                            F.lit("])")).alias("line"))
    test = lp.select(parse_labeled_point("line").alias("p")).select("p.label", "p.features")
    base = shared_dir(spark, "job-kmeans")
    q, state = jobs.start_kmeans(train, test, base, available_now=True)
    runners.drain(q, 300)
    pred = spark.read.parquet(f"{base}/predictions")
    assert pred.count() == 1000 and pred.where("cluster < 0 or cluster > 4").count() == 0

    reg = ev.select((F.col("value") / 50).alias("label"),
                    F.array(((F.col("user_id") - 75) / 45).cast("double")).alias("features"))
    base = shared_dir(spark, "job-linreg")
    q, state = jobs.start_linreg(reg, reg, base, available_now=True)
    runners.drain(q, 300)
    assert spark.read.parquet(f"{base}/predictions").count() == 1000
    assert state["last"] >= 0


def test_url_counts_job_reads_only_recent_batches(spark):
    """Three micro-batches: later views read only batches reaching the window."""
    from tidepool.streaming import sources
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = shared_dir(spark, "job-src")
    day = F.dayofmonth("ts")
    for cond in (day < 11, (day >= 11) & (day < 21), day >= 21):
        events.where(cond).coalesce(1).write.mode("append").parquet(src)
    ev = sources.table_stream(spark, src, events.schema, max_files_per_trigger=1)
    lines = ev.select(ntz_to_instant("ts").alias("ts"), fx.log_line().alias("line"))
    got, cb = _collector()
    window = 3 * 86400  # reaches back into the previous batch, not two back
    runners.drain(jobs.start_url_counts(lines, shared_dir(spark, "job-url3"), on_result=cb,
                                        window_s=window, available_now=True), 300)
    assert len(got) == 3
    urls = al.to_strict_urls(fx.logs(spark, SF_SMALL), "line", keep=("ts",))
    assert got[max(got)] == _expected_top(urls, "url", window=window)


def test_sessions_job_without_event_ids(spark):
    """Line sources (socket, Kafka) carry no event id; ties are broken by a generated one."""
    lines = _log_stream(spark, SF_SMALL).drop("event_id")
    got, cb = _collector()
    runners.drain(jobs.start_sessions(lines, shared_dir(spark, "job-sessions2"), on_result=cb,
                                      available_now=True), 300)
    assert got and max(len(r) for r in got.values()) > 0


def test_heartbeats_empty_the_window(spark):
    """With a heartbeat each second, old traffic leaves the window and an empty one is reported."""
    from tidepool.operators.alarm import ALARM_MESSAGE
    path = shared_dir(spark, "beat-src")
    now = int(time.time())
    rows = spark.range(150).select(F.timestamp_seconds(F.lit(now)).alias("ts"), F.lit("Failure").alias("status_class"))
    rows.write.parquet(path)
    sink = jobs.sinks.TickCountsSink(shared_dir(spark, "beat-ticks"), None, "ts", 1, {
        "failure": (F.col("status_class") == "Failure").cast("int")})
    seen = []

    def view(spark_, batch_id, last, ids):
        r = jobs._window_view(sink, spark_, last, 3, ids).first()
        seen.append((last, r["failure"] if r else None))

    stream = spark.readStream.schema(rows.schema).parquet(path)
    q = jobs._run(jobs._with_beats(stream, True), jobs._ticking(sink, view, 3), "beats", shared_dir(spark, "beat-base"))
    for _ in range(300):
        if seen and seen[-1][1] is None and any(n == 150 for _, n in seen) or not q.isActive:
            break
        time.sleep(0.2)
    q.stop()
    assert any(n == 150 for _, n in seen) and seen[-1][1] is None and ALARM_MESSAGE
    assert [t for t, _ in seen] == sorted(t for t, _ in seen)
