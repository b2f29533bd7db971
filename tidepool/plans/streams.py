"""Stream twins and sink round trips (STS5, STS6, SRC5, SNK2-SNK6).

Each query runs a real Structured Streaming query over the events table
(``availableNow`` trigger, one file a micro-batch, its own checkpoint in the
shared folder), lets the sink write, and returns what a reader of that sink
sees. Sinks keep mergeable parts per micro-batch (counts per tick, session
parts, figures per day), so the results are those of the batch twins however
the table is cut into files and in whatever order they come. Batches are days
of event time, as in the batch queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import accesslog as al
from tidepool.functions import text as tx
from tidepool.functions.vectors import parse_labeled_point
from tidepool.operators import alarm, batches, kmeans, textstats, topsteps, windows
from tidepool.session import shared_dir
from tidepool.sources import fixtures as fx
from tidepool.streaming import runners, sinks
from tidepool.streaming.datasources import read_committed, tail_lines, write_committed
from tidepool.streaming.ml import kmeans_replay
from tidepool.streaming.session_state import SessionStateJob
from tidepool.streaming.sessions import SessionPartsSink
from tidepool.streaming.sliding_state import SlidingStateJob
from tidepool.streaming.sources import status_files, table_stream, text_lines

STREAM_WINDOW, STREAM_SLIDE = "1 day", "1 hour"
ALARM_WINDOW = "12 hours"
BATCH_EVERY = "1 day"


def ntz_to_instant(c):
    """TIMESTAMP_NTZ (UTC wall clock) -> TIMESTAMP, independent of the session zone."""
    col = F.col(c) if isinstance(c, str) else c
    micros = (F.unix_timestamp(col) * 1_000_000
              + (F.date_part(F.lit("SECOND"), col) * 1_000_000).cast("bigint") % 1_000_000)
    return F.timestamp_micros(micros)


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    return table_stream(spark, path, schema, max_files_per_trigger=1)


def _log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_stream(spark, sf_dir)
    return ev.select("event_id", ntz_to_instant("ts").alias("ts"), fx.log_line().alias("line"))


def _statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_stream(spark, sf_dir)
    return ev.select("event_id", ntz_to_instant("ts").alias("ts"), fx.status_text().alias("text"))


def _run(df: DataFrame, fn, name: str) -> None:
    runners.drain(runners.start_foreach_batch(df, fn, name, available_now=True))


def _window_counts(spark: SparkSession, df: DataFrame, keys: list, name: str, window: str, slide: str,
                   measures: dict | None = None) -> DataFrame:
    """Sums per slide bucket and key stored by the stream, copied into windows when read."""
    sink = sinks.TickCountsSink(shared_dir(spark, name), keys, "ts", windows.parse_seconds(slide), measures)
    _run(df, sink, name)
    sums = sink.read(spark).withColumn("_t", F.timestamp_seconds("tick"))
    return windows.window_sums(sums, keys, {k: F.col(k) for k in sink.measures}, "_t", window, slide)


def stream_url_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Url counts per sliding window."""
    urls = al.to_strict_urls(_log_stream(spark, sf_dir), "line", keep=("ts",))
    return _window_counts(spark, urls, ["url"], "stream-url-windows", STREAM_WINDOW, STREAM_SLIDE)


def stream_hashtag_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's main job as a stream: top 10 hashtags per window."""
    tags = tx.hashtags(_statuses(spark, sf_dir), "text", "tag", keep=("ts",))
    counts = _window_counts(spark, tags, ["tag"], "stream-hashtags", STREAM_WINDOW, STREAM_SLIDE)
    return windows.top_k(counts, 10, ["window_start", "window_end"], "n", "tag")


def stream_hashtag_topk_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main job at 300 s / 1 s as a stream: per-second counts stored by it, the top 10 wherever the list changes."""
    tags = tx.hashtags(_statuses(spark, sf_dir), "text", "tag", keep=("ts",))
    sink = sinks.TickCountsSink(shared_dir(spark, "stream-hashtag-ticks"), "tag", "ts")
    _run(tags, sink, "hashtag_ticks")
    counts = sink.read(spark).withColumn("at", F.timestamp_seconds("tick"))
    return topsteps.top_k_steps(counts, "tag", 10, "at", "300 seconds", "1 second", amount=F.col("n"))


def stream_status_file_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4: status records land as JSON files; their hashtags counted per day by a stream over them."""
    path = shared_dir(spark, "status-files")
    ev = fx.table(spark, sf_dir, "events")
    ev.select(fx.status_text().alias("text"), ntz_to_instant("ts").alias("ts")).write.json(path)
    tags = tx.hashtags(status_files(spark, path, max_files_per_trigger=1), "text", "tag", keep=("ts",))
    sink = sinks.TickCountsSink(shared_dir(spark, "status-hashtags"), "tag", "ts", windows.parse_seconds(BATCH_EVERY))
    _run(tags, sink, "status_hashtags")
    return (sink.read(spark).groupBy((F.col("tick") / windows.parse_seconds(BATCH_EVERY)).cast("bigint").alias("batch_id"), "tag")
                .agg(F.sum("n").alias("n")))


def stream_text_line_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6: labelled points in text files with CR LF line ends, read as a stream and parsed."""
    path = shared_dir(spark, "point-lines")
    fx.labeled_point_lines(spark, sf_dir).select(F.concat("line", F.lit("\r")).alias("value")).write.text(path)
    lines = text_lines(spark, path, stream=True)
    points = _staged(spark, lines.select(parse_labeled_point("line").alias("p")).select("p.*"), "stream-points")
    return points.select("label", F.col("features")[0].alias("f0"), F.col("features")[1].alias("f1"), "parse_ok")


def _outcomes() -> dict:
    return {"success": (F.col("status_class") == "Success").cast("int"),
            "failure": (F.col("status_class") == "Failure").cast("int")}


def stream_error_rate_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG4 on a stream: success/failure per 12-hour window (1-hour slide)."""
    cls = al.to_status_classes(_log_stream(spark, sf_dir), "line", keep=("ts",))
    sums = _window_counts(spark, cls, [], "stream-alarm", ALARM_WINDOW, STREAM_SLIDE, _outcomes())
    return sums.withColumn("state", alarm.alarm_state(F.col("success"), F.col("failure")))


def stream_alarm_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK7: the alarm's messages for each window of the stream."""
    return alarm.alarm_messages(stream_error_rate_alarm(spark, sf_dir)).select(
        "window_start", "totals_message", "alarm_message")


def _session_sink(spark: SparkSession, sf_dir: str, name: str) -> SessionPartsSink:
    visits = al.to_visits(_log_stream(spark, sf_dir), "line", keep=("event_id", "ts"))
    sink = SessionPartsSink(shared_dir(spark, name))
    _run(visits, sink, name)
    return sink


def _clicks(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols, F.size("clickstream").alias("clicks"), F.concat_ws(" ", "clickstream").alias("clickstream"))


def stream_session_first10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and first 10 urls per ip, from session parts stored by the stream."""
    return _clicks(_session_sink(spark, sf_dir, "stream-sessions").first_clicks(spark), "ip", "session_length")


def stream_session_gap_first10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STS2: sessions split at 30 idle minutes, count and first 10 urls each."""
    out = _session_sink(spark, sf_dir, "stream-gap-sessions").gap_sessions(spark)
    return _clicks(out, "ip", "session_start", "session_end", "requests")


def stream_session_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STS3 + STS4: the sessions still open at the last request, through the reference's SQL."""
    return _clicks(_session_sink(spark, sf_dir, "stream-snapshot").snapshot_sql(spark), "ip", "session_length")


def _session_state(spark: SparkSession, sf_dir: str, name: str) -> SessionStateJob:
    job = SessionStateJob(shared_dir(spark, name))
    runners.drain(job.start(al.to_visits(_log_stream(spark, sf_dir), "line", keep=("event_id", "ts")), available_now=True))
    return job


def stream_session_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STS1 + STS2 as keyed state: closed by the watermark's timers, late pieces and open state merged."""
    return _clicks(_session_state(spark, sf_dir, "state-sessions").sessions(spark), "ip", "session_start", "session_end", "requests")


def stream_session_state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STS3: the open sessions, read from the state store."""
    return _clicks(_session_state(spark, sf_dir, "state-snapshot").snapshot(spark), "ip", "session_length")


def stream_url_ring_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1 as keyed state: a ring of 300 ticks a key, shifted by timers; what is ahead of the watermark from the state store."""
    job = SlidingStateJob(shared_dir(spark, "ring-urls"), "url")
    runners.drain(job.start(al.to_strict_urls(_log_stream(spark, sf_dir), "line", keep=("ts",)), available_now=True))
    return job.steps(spark)


DAY_SQL = "select day, agent, count(*) as total from requests group by day, agent"


def stream_agent_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's SQL run on every micro-batch (AGG3 through foreachBatch), by day of event time."""
    records = al.to_records(_log_stream(spark, sf_dir), "line", keep=("ts",))
    out = shared_dir(spark, "stream-agent-sql")
    _run(records.withColumn("day", batches.batch_id("ts", BATCH_EVERY)),
         runners.sql_each_batch(DAY_SQL, sink=runners.append_parquet(out)), "agent_sql")
    return (spark.read.parquet(out).groupBy(F.col("day").alias("batch_id"), "agent")
                 .agg(F.sum("total").alias("total")))


def stream_text_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6: counter and gauges of status texts after each day.

    Each micro-batch's figures per day are stored and merged; the live job
    (``jobs.start_length_gauges``) observes the same figures inside its batches.
    """
    out = shared_dir(spark, "stream-text-metrics")

    def figures(batch_df: DataFrame, batch_id: int) -> None:
        (batch_df.groupBy(batches.batch_id("ts", BATCH_EVERY).alias("day")).agg(*sinks.text_metric_columns("text"))
                 .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}"))

    _run(_statuses(spark, sf_dir), figures, "text_metrics")
    per_day = (spark.read.parquet(out).groupBy(F.col("day").alias("batch_id"))
                    .agg(F.sum("tweets").alias("n"), F.sum("chars").alias("chars"), F.max("longest").alias("longest")))
    return textstats.running_text_length(per_day).select(
        "batch_id", F.col("total_n").alias("counter"), "avg_length", F.col("longest").alias("longest_in_batch"))


def sink_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2: records written as JSON per non-empty batch, all read back."""
    records = al.to_records(_log_stream(spark, sf_dir), "line", keep=("event_id",))
    path = shared_dir(spark, "requests-json")
    _run(records, sinks.json_nonempty(path), "json_sink")
    return (spark.read.schema("event_id bigint, url string, status int, agent string, batch_id bigint").json(path)
                 .drop("batch_id"))


def sink_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3: status texts saved per batch, all read back."""
    capture = sinks.TextCapture(shared_dir(spark, "tweets-text"))
    _run(_statuses(spark, sf_dir), capture, "text_sink")
    return spark.read.text(f"{capture.base}/batch_id=*").select("value")


def sink_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK5: row projection upserted by the stream, last request per (ip, url) wins."""
    rows = al.to_rows(_log_stream(spark, sf_dir), "line", keep=("event_id", "ts"))
    table = sinks.UpsertTable(shared_dir(spark, "row-store"), ["ip", "url"], ["ts", "event_id"])
    _run(rows, table, "row_store")
    return table.read(spark).select("ip", "url", "status", "user_agent", "event_id")


def stream_tail_url_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1/SRC2 without a port: log lines read from text files by byte offsets, counted by url."""
    path, out = shared_dir(spark, "tail-lines"), shared_dir(spark, "tail-counts")
    fx.logs(spark, sf_dir).select(F.col("line").alias("value")).write.text(path)
    urls = al.to_strict_urls(tail_lines(spark, path), "line")

    def counted(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.groupBy("url").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    _run(urls, counted, "tail_urls")
    return spark.read.parquet(out).groupBy("url").agg(F.sum("n").alias("n"))


def sink_committed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK5/SNK7 by format name: records written by tasks, named by the driver's commits, read back."""
    records = al.to_records(_log_stream(spark, sf_dir), "line", keep=("event_id",))
    path = shared_dir(spark, "committed-rows")
    runners.drain(write_committed(records, path, shared_dir(spark, "checkpoint-committed"), available_now=True))
    return read_committed(spark, path, records.schema).select("event_id", "url", "status", "agent")


def _staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """All rows of a stream, stored per micro-batch."""
    out = shared_dir(spark, name)
    _run(df, lambda batch_df, batch_id: batch_df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}"), name)
    return spark.read.parquet(out).drop("batch_id")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_stream(spark, sf_dir)
    return ev.select("event_id", ntz_to_instant("ts").alias("ts"), (F.col("event_id") % 5).cast("int").alias("label"),
                     F.array(F.col("value").cast("double"), F.col("user_id").cast("double")).alias("features"))


def stream_kmeans_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML1 on a stream: points stored per micro-batch, the model trained day after day."""
    from tidepool.plans.queries import KMEANS_DIGITS, _first_centres
    points = batches.with_batch(_staged(spark, _points(spark, sf_dir), "stream-kmeans"), "ts", BATCH_EVERY)
    model = kmeans.StreamingKMeansModel.given(_first_centres(points, kmeans.K))
    out = kmeans_replay(points, "features", "batch_id", model)
    return out.select("batch_id", "cluster", "weight",
                      *[F.round(F.col("centre")[i], KMEANS_DIGITS).alias(f"c_{i}") for i in range(kmeans.DIM)])


def stream_kmeans_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML1 + ML2 on a stream: one update over all stored training points, every point scored with it."""
    from tidepool.plans.queries import _first_centres
    points = _staged(spark, _points(spark, sf_dir), "stream-kmeans-predict")
    model = kmeans.StreamingKMeansModel.given(_first_centres(points, kmeans.K))
    model.train_batch(points, "features")
    return model.predict(points, "features").select("event_id", "label", "cluster")


def stream_url_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1 at 300 s / 1 s on a stream without window state: per-second url
    counts per micro-batch into a table, the step function computed over it."""
    urls = al.to_strict_urls(_log_stream(spark, sf_dir), "line", keep=("ts",))
    sink = sinks.TickCountsSink(shared_dir(spark, "stream-url-ticks"), "url", "ts")
    _run(urls, sink, "url_ticks")
    return sink.sliding(spark, "300 seconds", keep_zero=True)


def stream_error_rate_alarm_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's alarm on a stream at 300 s / 1 s: per-second success and
    failure sums per micro-batch, the alarm rule over the step function."""
    cls = al.to_status_classes(_log_stream(spark, sf_dir), "line", keep=("ts",))
    sink = sinks.TickCountsSink(shared_dir(spark, "stream-alarm-ticks"), None, "ts", 1, _outcomes())
    _run(cls, sink, "alarm_ticks")
    s = sink.sliding(spark, "300 seconds", keep_zero=True)
    return s.select("tick", "success", "failure",
                    alarm.alarm_state(F.col("success"), F.col("failure")).alias("state"))


STREAM_QUERIES = {
    "stream_url_window_counts": stream_url_window_counts,
    "stream_session_first10": stream_session_first10,
    "stream_agent_batch_counts": stream_agent_batch_counts,
    "sink_json_roundtrip": sink_json_roundtrip,
    "sink_text_roundtrip": sink_text_roundtrip,
    "sink_upsert": sink_upsert,
    "stream_kmeans_step": stream_kmeans_step,
    "stream_kmeans_predict": stream_kmeans_predict,
    "stream_hashtag_topk": stream_hashtag_topk,
    "stream_error_rate_alarm": stream_error_rate_alarm,
    "stream_text_metrics": stream_text_metrics,
    "stream_session_snapshot": stream_session_snapshot,
    "stream_url_sliding_counts": stream_url_sliding_counts,
    "stream_error_rate_alarm_ticks": stream_error_rate_alarm_ticks,
    "stream_session_gap_first10": stream_session_gap_first10,
    "stream_alarm_messages": stream_alarm_messages,
    "stream_status_file_hashtags": stream_status_file_hashtags,
    "stream_text_line_points": stream_text_line_points,
    "stream_session_state": stream_session_state,
    "stream_session_state_snapshot": stream_session_state_snapshot,
    "stream_hashtag_topk_ticks": stream_hashtag_topk_ticks,
    "stream_url_ring_counts": stream_url_ring_counts,
    "stream_tail_url_counts": stream_tail_url_counts,
    "sink_committed_rows": sink_committed_rows,
}
