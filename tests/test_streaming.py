"""Stream twins equal batch twins; sinks are idempotent under batch replay."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.session import shared_dir
from tidepool.streaming import sinks, sources

from conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_sessions_equal_batch(spark):
    from tidepool.plans import queries, streams
    assert _same(streams.stream_session_first10(spark, SF_SMALL),
                 queries.session_first10(spark, SF_SMALL))


def test_stream_window_counts_equal_batch(spark):
    from tidepool.functions import accesslog as al
    from tidepool.operators import windows
    from tidepool.plans import streams
    from tidepool.sources import fixtures as fx
    batch = windows.window_counts(al.to_strict_urls(fx.logs(spark, SF_SMALL), "line", keep=("ts",)),
                                  "url", "ts", streams.STREAM_WINDOW, streams.STREAM_SLIDE)
    assert _same(streams.stream_url_window_counts(spark, SF_SMALL), batch)


def test_upsert_replay_is_idempotent(spark):
    t = sinks.UpsertTable(shared_dir(spark, "upsert-test"), ["k"], ["v"])
    b0 = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    b1 = spark.createDataFrame([("a", 2), (None, 5)], "k string, v int")
    t.merge(b0, 0)
    t.merge(b1, 1)
    t.merge(b1, 1)  # replay of batch 1 after a failure
    got = sorted((r["k"] or "", r["v"]) for r in t.read(spark).collect())
    assert got == [("", 5), ("a", 2), ("b", 1)]
    t.compact(spark, 1)
    t.merge(spark.createDataFrame([("b", 7)], "k string, v int"), 2)
    got = sorted((r["k"] or "", r["v"]) for r in t.read(spark).collect())
    assert got == [("", 5), ("a", 2), ("b", 7)]


def test_capture_limit(spark):
    """A batch past the limit is refused, not swallowed; a new process goes on counting."""
    base = shared_dir(spark, "capture-test")
    texts = lambda n: spark.range(n).select(F.col("id").cast("string").alias("text"))
    cap = sinks.TextCapture(base, limit=100)
    cap(texts(60), 0)
    cap(texts(0), 1)
    again = sinks.TextCapture(base, limit=100)
    again(texts(50), 2)
    assert again.total == 110 and again.done
    with pytest.raises(sinks.CaptureFull):
        again(texts(30), 3)
    with pytest.raises(sinks.CaptureFull):
        sinks.TextCapture(base, limit=100)(texts(30), 3)
    assert spark.read.text(f"{base}/batch_id=*").count() == 110


def _layout(spark, name, order):
    """The small events as four files in the given order of quarters; other tables as they are."""
    base = shared_dir(spark, name)
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for q in order:
        (events.withColumn("_q", F.ntile(4).over(Window.partitionBy().orderBy("ts", "event_id"))).where(F.col("_q") == q)
               .drop("_q").coalesce(1).write.mode("append").parquet(f"{base}/events.parquet"))
    return base


@pytest.mark.parametrize("order", [(1, 2, 3, 4), (4, 1, 2, 3)], ids=["in-order", "newest-first"])
def test_stream_queries_for_any_file_layout(spark, order):
    """Every stream and sink query equals its SQL twin however the events are cut into files."""
    import duckdb
    from tidepool.plans.oracle import ORACLE
    from tidepool.plans.streams import STREAM_QUERIES
    base = _layout(spark, f"layout-{order[0]}", order)
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{SF_SMALL}/events.parquet'")

    def rows(columns, data):
        picked = [columns.index(c) for c in sorted(columns)]
        return sorted((tuple(round(r[i], 5) if isinstance(r[i], float) else r[i] for i in picked) for r in data), key=str)

    for name, query in STREAM_QUERIES.items():
        got = query(spark, base)
        want = con.sql(ORACLE[name])
        assert rows(got.columns, map(tuple, got.collect())) == rows(want.columns, want.fetchall()), name


def test_drain_raises_on_timeout(spark):
    import time
    from tidepool.streaming import runners
    path = shared_dir(spark, "slow-src")
    spark.range(10).write.parquet(path)
    stream = spark.readStream.schema("id long").parquet(path)
    q = runners.start_foreach_batch(stream, lambda df, i: time.sleep(30), "slow", available_now=True)
    with pytest.raises(TimeoutError):
        runners.drain(q, 2)
    assert not q.isActive


def test_shared_dir_needs_a_folder_on_a_cluster():
    from tidepool import session

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Cluster:
        conf = Conf({"spark.master": "spark://host:7077"})

        class sparkContext:  # noqa: N801
            @staticmethod
            def getConf():
                return Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster, "x")
    Cluster.conf["spark.checkpoint.dir"] = "hdfs://shared/"
    assert session.shared_dir(Cluster, "x", unique=False) == "hdfs://shared/tidepool/x"


def test_gauges_go_on_after_a_restart(spark):
    """Figures of earlier batches are read again; other queries' progress is not counted."""
    from types import SimpleNamespace as N
    folder, got = shared_dir(spark, "gauge-totals"), []
    event = lambda q, b, n, c: N(progress=N(id=q, batchId=b, observedMetrics={"text_metrics": {"tweets": n, "chars": c, "longest": 9}}))
    for batch, (n, c) in enumerate([(2, 10), (3, 20)]):
        listener = sinks.MetricsListener(lambda name, b, m: got.append(m), spark=spark, totals_dir=folder)
        listener.watch(N(id="q1"))
        listener.onQueryProgress(event("q2", 7, 100, 100))
        listener.onQueryProgress(event("q1", batch, n, c))
        listener.onQueryProgress(event("q1", batch, n, c))  # reported twice
    assert [m["counter"] for m in got] == [2, 2, 5, 5] and got[-1]["avg_length"] == 6


def test_source_options_without_ports():
    assert sources.socket_options("h", 7777) == {"host": "h", "port": "7777", "includeTimestamp": "true"}
    assert sources.kafka_options()["subscribe"] == "testLogs"
    assert sources.stream_path("/d/events.parquet") == "/d/events.parque[t]"
    assert sources.stream_path("/d/dir") == "/d/dir"


def test_observed_metrics(spark):
    df = spark.createDataFrame([("ab",), ("abcd",)], "text string")
    observed, obs = sinks.observe_text_metrics(df)
    observed.collect()
    assert obs.get == {"tweets": 2, "chars": 6, "longest": 4}


def test_restart_from_checkpoint_gives_same_table(spark):
    """Stop after the first file, restart on the same checkpoint with the rest:
    the parts equal one uninterrupted run."""
    from tidepool.functions import accesslog as al
    from tidepool.plans.streams import ntz_to_instant
    from tidepool.sources import fixtures as fx
    from tidepool.streaming import runners
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    day, src, cp = F.dayofmonth("ts"), shared_dir(spark, "src-split"), shared_dir(spark, "cp-split")
    sink = sinks.TickCountsSink(shared_dir(spark, "restart-ticks"), "url", "ts", 3600)
    for cond in (day < 11, (day >= 11) & (day < 21), day >= 21):
        events.where(cond).coalesce(1).write.mode("append").parquet(src)
        ev = sources.table_stream(spark, src, events.schema, max_files_per_trigger=1)
        logs = ev.select("event_id", ntz_to_instant("ts").alias("ts"), fx.log_line().alias("line"))
        urls = al.to_strict_urls(logs, "line", keep=("ts",))
        runners.drain(runners.start_foreach_batch(urls, sink, "restart_test", available_now=True, checkpoint=cp), 600)
    got = sink.read(spark).groupBy("url", "tick").agg(F.sum("n").alias("n"))
    want = al.to_strict_urls(fx.logs(spark, SF_SMALL), "line", keep=("ts",)).groupBy(
        "url", (F.floor(F.unix_timestamp("ts") / 3600) * 3600).alias("tick")).agg(F.count("*").alias("n"))
    assert _same(got, want)


def test_crlf_text_files_parse(spark):
    """SRC6 + PRJ9/PRJ10: reference-format training lines with CRLF endings."""
    from tidepool.functions.vectors import parse_labeled_point, parse_vector
    path = shared_dir(spark, "crlf-lines")
    lines = ["[172153.58,22]\r", "[143383.71,21]\r"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    df = sources.text_lines(spark, path)
    assert sorted(r["line"] for r in df.collect()) == ["[143383.71,21]", "[172153.58,22]"]
    vecs = sorted(tuple(r[0]) for r in df.select(parse_vector("line")).collect())
    assert vecs == [(143383.71, 21.0), (172153.58, 22.0)]
    lp = spark.createDataFrame([("(0,[172153.58,22])\r",)], "line string").select(
        parse_labeled_point("line").alias("p")).first()["p"]
    assert (lp["label"], lp["features"], lp["parse_ok"]) == (0.0, [172153.58, 22.0], True)


def test_latest_top_k(spark):
    from tidepool.operators.windows import latest_top_k
    df = spark.createDataFrame([("a", 3), ("b", 5), ("c", 5), ("d", 1)], "key string, n long")
    assert [r["key"] for r in latest_top_k(df, 3).collect()] == ["b", "c", "a"]
    assert [r["key"] for r in latest_top_k(df, 2, ascending=True).collect()] == ["d", "a"]


def test_tick_counts_stream_any_batching(spark):
    """Per-second counts appended per micro-batch give the batch step function
    whatever the batching (three files, one per micro-batch)."""
    from tidepool.functions import accesslog as al
    from tidepool.operators import windows
    from tidepool.plans.streams import _run, ntz_to_instant
    from tidepool.sources import fixtures as fx
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = shared_dir(spark, "src-ticks")
    day = F.dayofmonth("ts")
    for cond in (day < 11, (day >= 11) & (day < 21), day >= 21):
        events.where(cond).coalesce(1).write.mode("append").parquet(src)
    ev = sources.table_stream(spark, src, events.schema, max_files_per_trigger=1)
    logs = ev.select("event_id", ntz_to_instant("ts").alias("ts"), fx.log_line().alias("line"))
    sink = sinks.TickCountsSink(shared_dir(spark, "ticks"), "url", "ts")
    _run(al.to_strict_urls(logs, "line", keep=("ts",)), sink, "ticks_test")
    assert spark.read.parquet(sink.path).select("batch_id").distinct().count() == 3
    batch = windows.sliding_counts(al.to_strict_urls(fx.logs(spark, SF_SMALL), "line", keep=("ts",)),
                                   "url", "ts", "300 seconds", "1 second")
    assert _same(sink.sliding(spark), batch)


def test_console_writer_and_preview(spark):
    from pyspark.sql.streaming import DataStreamWriter
    from tidepool.operators.windows import first_n
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    stream = sources.table_stream(spark, f"{SF_SMALL}/events.parquet", schema)
    assert isinstance(sinks.console(stream), DataStreamWriter)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert [r["event_id"] for r in first_n(ev, 3, ["event_id"]).collect()] == [0, 1, 2]


def test_status_files_stream_hashtags(spark):
    """SRC4 re-aimed: JSON status files streamed into hashtag counts."""
    from tidepool.functions import text as tx
    path = shared_dir(spark, "status-json")
    spark.createDataFrame([("#a b #c", "2024-01-01 00:00:00"), ("#a  ", "2024-01-01 00:00:01")],
                          "text string, ts string") \
         .select("text", F.col("ts").cast("timestamp").alias("ts")).write.json(path)
    got = {}

    def collect(batch_df, batch_id):
        for r in batch_df.groupBy("tag").count().collect():
            got[r["tag"]] = got.get(r["tag"], 0) + r["count"]

    from tidepool.streaming import runners
    tags = tx.hashtags(sources.status_files(spark, path), "text", "tag")
    runners.drain(runners.start_foreach_batch(tags, collect, "status_files_test", available_now=True), 300)
    assert got == {"#a": 2, "#c": 1}


def test_alarm_messages(spark):
    from tidepool.operators.alarm import ALARM_MESSAGE, ALL_CLEAR_MESSAGE, alarm_messages, alarm_state
    df = spark.createDataFrame([(10, 101), (90, 20), (5, 5)], "success long, failure long")
    out = alarm_messages(df.withColumn("state", alarm_state(F.col("success"), F.col("failure")))).collect()
    assert [r["state"] for r in out] == ["alarm", "ok", "quiet"]
    assert [r["alarm_message"] for r in out] == [ALARM_MESSAGE, ALL_CLEAR_MESSAGE, None]
    assert out[0]["totals_message"] == "Total success: 10 Total failure: 101"


def test_upsert_auto_compaction(spark):
    t = sinks.UpsertTable(shared_dir(spark, "upsert-compact"), ["k"], ["v"], compact_every=2)
    for b, (k, v) in enumerate([("a", 1), ("b", 2), ("a", 3), ("c", 4), ("b", 0)]):
        t.merge(spark.createDataFrame([(k, v)], "k string, v int"), b)
    assert t._version(spark) == 4
    t.merge(spark.createDataFrame([("d", 5)], "k string, v int"), 5)
    files = {x.split("/upsert-compact", 1)[1].split("/", 1)[1].split("/part")[0] for x in t.read(spark).inputFiles()}
    assert files == {"base/v=4", "delta/after=4/batch_id=5"}  # nothing older is listed
    got = sorted((r["k"], r["v"]) for r in t.read(spark).collect())
    assert got == [("a", 3), ("b", 2), ("c", 4), ("d", 5)]  # order column decides, not arrival
