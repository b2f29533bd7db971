"""Ready-to-start streaming jobs, one per reference job.

Each ``start_*`` takes a streaming DataFrame from :mod:`tidepool.streaming.sources`
(``line``/``text`` plus an event-time ``ts`` TIMESTAMP) and a working folder, and
returns the started ``StreamingQuery``. Per-tick views ("top 10 in the last 300 s",
"totals in the last 300 s") are computed in ``foreachBatch`` from per-second
counts: only the stored batches whose ticks reach into the current window are
read, so no job keeps 300 copies of each row in window state and the per-batch
cost does not grow with the stream's history. The window's end never moves back.
A live job also gets a heartbeat row a second, so results go on while no traffic
comes: counts fall, an alarm clears, an emptied window is reported.
Results go to a callback ``on_result(batch_id, rows)`` (default: print), rows
being a short list (top k, one alarm line).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.functions import accesslog as al
from tidepool.functions import text as tx
from tidepool.operators.alarm import ALARM_MESSAGE, ALL_CLEAR_MESSAGE, MIN_TOTAL, ALARM_RATIO
from tidepool.operators.batches import BATCH_SQL, CAPTURE_LIMIT
from tidepool.operators.kmeans import StreamingKMeansModel
from tidepool.operators.linreg import StreamingLinearModel
from tidepool.streaming import runners, sinks
from tidepool.streaming.ml import kmeans_foreach_batch, linreg_foreach_batch
from tidepool.streaming.session_state import SessionStateJob
from tidepool.streaming.sessions import SNAPSHOT_SQL, SNAPSHOT_VIEW

WINDOW_S = 300
TOP_K = 10


def _print(batch_id, rows):
    print(f"========= batch {batch_id} =========")
    for r in rows:
        print(r)


def _run(df, fn, name, base, mode="append", available_now=False, interval=runners.BATCH_INTERVAL):
    return runners.start_foreach_batch(df, fn, name, output_mode=mode, available_now=available_now,
                                       interval=interval, checkpoint=f"{base}/checkpoint")


def _window_view(sink: sinks.TickCountsSink, spark, until_tick: int, window_s: int,
                 batch_ids=None) -> DataFrame:
    """Sums per key over ticks (until - window, until]: the current window."""
    if isinstance(sink, sinks.TieredTickCounts):
        c = sink.since(spark, until_tick - window_s)
    else:
        c = sink.read(spark) if batch_ids is None \
            else sink.read(spark, batch_ids) if batch_ids else sink.read(spark).limit(0)
    c = c.where((F.col("tick") > until_tick - window_s) & (F.col("tick") <= until_tick))
    return c.groupBy(*sink.keys).agg(*[F.sum(k).alias(k) for k in sink.measures])


BEAT = "_beat"


def _with_beats(df: DataFrame, live: bool) -> DataFrame:
    """``df`` and, in a live job, a row a second that holds only the time."""
    df = df.withColumn(BEAT, F.lit(False))
    if not live:
        return df
    beats = df.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("ts", BEAT)
             else (F.col("timestamp").alias("ts") if f.name == "ts" else F.lit(True).alias(BEAT)) for f in df.schema]
    return df.unionByName(beats.select(*empty))


def _ticking(sink: sinks.TickCountsSink, view, window_s: int):
    """foreachBatch: store this batch's per-second sums, then show the view at the last tick.

    The tick range of the stored batches that reach into the window is remembered,
    so the view reads only those; after a restart it reads everything once.
    """
    ranges: dict[int, tuple[int, int]] = {}
    state = {"restarted": True, "last": None}

    def run(batch_df: DataFrame, batch_id: int) -> None:
        batch_df = batch_df.persist()
        try:
            secs, real = F.unix_timestamp(sink.time_col), ~F.col(BEAT)
            lo, hi, end = batch_df.agg(F.min(F.when(real, secs)), F.max(F.when(real, secs)), F.max(secs)).first()
            if hi is not None:  # a second without traffic leaves no folder
                sink(batch_df.where(real).drop(BEAT), batch_id)
        finally:
            batch_df.unpersist()
        spark = batch_df.sparkSession
        if state["restarted"]:
            stored = sink.read(spark).agg(F.max("tick")).first()[0]
            state["last"] = stored if stored is not None else end
        if end is not None:
            state["last"] = max(state["last"], int(end))
        if hi is not None:
            ranges[batch_id] = (int(lo), int(hi))
        last = state["last"]
        if last is None:
            return
        for b in [b for b, (_, z) in ranges.items() if z <= last - window_s]:
            del ranges[b]  # the window has left it for good
        ids = None if state["restarted"] else list(ranges)
        state["restarted"] = False
        view(spark, batch_id, last, ids)
    return run


def _top_counts_job(keyed: DataFrame, key: str, base: str, name: str, on_result, window_s: int,
                    k: int, available_now: bool) -> StreamingQuery:
    sink = sinks.TieredTickCounts(f"{base}/ticks", key, "ts", window_s=window_s)

    def view(spark, batch_id, last, ids):
        top = (_window_view(sink, spark, last, window_s, ids).where(F.col("n") > 0)
               .orderBy(F.desc("n"), F.asc(key)).limit(k).collect())
        on_result(batch_id, [(r[key], r["n"]) for r in top])

    return _run(_with_beats(keyed.select(key, "ts"), not available_now), _ticking(sink, view, window_s), name, base,
                available_now=available_now)


# ------------------------------------------------------------------ log jobs
def start_url_counts(lines: DataFrame, base: str, leak: bool = False, on_result=_print,
                     window_s: int = WINDOW_S, k: int = TOP_K, available_now: bool = False):
    """Top urls (strict rule; ``leak=True`` keys bad requests as ``()``) over the window."""
    label = al.LEAK_LABEL if leak else al.ERROR_LABEL
    urls = al.to_strict_urls(lines, "line", keep=("ts",), bad_request_label=label)
    return _top_counts_job(urls, "url", base, "url_counts", on_result, window_s, k, available_now)


def start_alarm(lines: DataFrame, base: str, on_result=_print, window_s: int = WINDOW_S,
                min_total: int = MIN_TOTAL, ratio: float = ALARM_RATIO, available_now: bool = False):
    """Success/failure totals over the window each batch, and the alarm line."""
    cls = al.to_status_classes(lines, "line", keep=("ts",))
    sink = sinks.TickCountsSink(f"{base}/ticks", None, "ts", 1, {
        "success": (F.col("status_class") == "Success").cast("int"),
        "failure": (F.col("status_class") == "Failure").cast("int")})

    def view(spark, batch_id, last, ids):
        r = _window_view(sink, spark, last, window_s, ids).first()
        s, f = (r["success"] or 0, r["failure"] or 0) if r else (0, 0)
        out = [f"Total success: {s} Total failure: {f}"]
        if s + f > min_total:
            out.append(ALARM_MESSAGE if f > ratio * s else ALL_CLEAR_MESSAGE)
        on_result(batch_id, out)

    return _run(_with_beats(cls, not available_now), _ticking(sink, view, window_s), "alarm", base,
                available_now=available_now)


def start_batch_sql(lines: DataFrame, base: str, sql: str = BATCH_SQL, available_now: bool = False):
    """The per-batch SQL over ``requests``; results stored per batch id under ``base/out``."""
    records = al.to_records(lines, "line")
    return _run(records, runners.sql_each_batch(sql, sink=runners.append_parquet(f"{base}/out")),
                "batch_sql", base, available_now=available_now)


def start_json_requests(lines: DataFrame, base: str, overwrite: bool = False, available_now: bool = False):
    """Records of each non-empty batch as JSON under ``base/requests/batch_id=N``
    (``overwrite``: only the last batch, at ``base/requests``, as in the reference)."""
    return _run(al.to_records(lines, "line"), sinks.json_nonempty(f"{base}/requests", overwrite),
                "json_requests", base, available_now=available_now)


def _with_event_id(lines: DataFrame) -> DataFrame:
    """Line sources carry no event id: lines of one time are ordered by a hash."""
    return lines if "event_id" in lines.columns else lines.withColumn("event_id", F.xxhash64("line"))


def start_row_store(lines: DataFrame, base: str, keys=("ip", "url"), format: str = "parquet",
                    compact_every: int = 360, available_now: bool = False):
    """Rows ``(ip, url, status, user_agent)`` upserted every 10 s into ``base/table``.

    Returned with the table, whose ``rows_written`` counts; the deltas are folded
    into a new base once an hour."""
    rows = al.to_rows(_with_event_id(lines), "line", keep=("ts", "event_id"))
    table = sinks.UpsertTable(f"{base}/table", list(keys), ["ts", "event_id"], compact_every, format)
    return _run(rows, table, "row_store", base, available_now=available_now,
                interval=runners.ROW_STORE_INTERVAL), table


def _snapshot_sql(spark, snapshot: DataFrame) -> DataFrame:
    """STS4: SQL over the snapshot registered as ``sessionData``."""
    snapshot.createOrReplaceTempView(SNAPSHOT_VIEW)
    return spark.sql(SNAPSHOT_SQL)


def start_sessions(lines: DataFrame, base: str, on_result=_print, available_now: bool = False, salts: int = 1):
    """Per-ip sessions (count + first 10 urls, 30-minute idle timeout) in keyed state; each batch
    the open sessions are queried with the reference's SQL. Closed and late ones go to a table."""
    visits = al.to_visits(_with_event_id(lines), "line", keep=("event_id", "ts"))

    def show(open_now: DataFrame, batch_id: int) -> None:
        snapshot = open_now.select("ip", F.col("requests").alias("session_length"), F.col("clicks.item").alias("clickstream"))
        shown = _snapshot_sql(open_now.sparkSession, snapshot).orderBy("ip").limit(20).collect()  # what show() prints
        on_result(batch_id, [tuple(r) for r in shown])

    job = SessionStateJob(f"{base}/sessions", salts=salts)
    return job.start(_with_beats(visits, not available_now), show, available_now, beat_col=BEAT)


def session_snapshot(spark, base: str) -> DataFrame:
    """The sessions job's open sessions as a table (``select * from sessionData``)."""
    return _snapshot_sql(spark, SessionStateJob(f"{base}/sessions").snapshot(spark))


# --------------------------------------------------------------- status jobs
def start_top_hashtags(statuses: DataFrame, base: str, on_result=_print, window_s: int = WINDOW_S,
                       k: int = TOP_K, available_now: bool = False):
    tags = tx.hashtags(statuses, "text", "tag", keep=("ts",))
    return _top_counts_job(tags, "tag", base, "top_hashtags", on_result, window_s, k, available_now)


def start_top_words(statuses: DataFrame, base: str, on_result=_print, window_s: int = WINDOW_S,
                    k: int = TOP_K, available_now: bool = False):
    words = tx.content_words(statuses, "text", "word", keep=("ts",))
    return _top_counts_job(words, "word", base, "top_words", on_result, window_s, k, available_now)


def start_save_statuses(statuses: DataFrame, base: str, limit: int = CAPTURE_LIMIT,
                        available_now: bool = False):
    """Save texts per batch until more than ``limit`` are saved; the caller stops the
    query when ``capture.done`` (returned alongside), e.g. by ``runners.drain_capture``."""
    capture = sinks.TextCapture(f"{base}/texts", limit=limit)
    q = _run(statuses.select("text"), capture, "save_statuses", base, available_now=available_now)
    return q, capture


def start_length_gauges(statuses: DataFrame, base: str, on_result=_print, available_now: bool = False):
    """Counter, average length (integer division) and longest length per batch,
    observed inside each batch's own job; a listener forwards them."""
    spark = statuses.sparkSession
    listener = sinks.MetricsListener(lambda name, batch_id, m: on_result(batch_id, [m]), spark=spark,
                                     totals_dir=f"{base}/totals")
    spark.streams.addListener(listener)
    observed, _ = sinks.observe_text_metrics(statuses.select("text"), "text")
    q = (observed.writeStream.format("noop").queryName(f"text_metrics-{uuid.uuid4().hex[:8]}")
                 .option("checkpointLocation", f"{base}/checkpoint"))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime=runners.BATCH_INTERVAL)
    query = q.start()
    listener.watch(query)
    return query, listener


# ---------------------------------------------------------------- model jobs
def start_kmeans(train: DataFrame, test: DataFrame, base: str, model: StreamingKMeansModel | None = None,
                 available_now: bool = False):
    """Train on ``train`` (``features``) and score ``test`` (``label``, ``features``) in
    the same micro-batches; models under ``base/model``, predictions under ``base/predictions``."""
    model = model or StreamingKMeansModel.random()
    rows = (train.select(F.lit(None).cast("int").alias("label"), "features", F.lit("train").alias("role"))
                 .unionByName(test.select(F.col("label").cast("int").alias("label"), "features",
                                          F.lit("test").alias("role"))))
    fn = kmeans_foreach_batch(model, "features", f"{base}/model", role_col="role",
                              predict_dir=f"{base}/predictions", keep=("label",))
    return _run(rows, fn, "kmeans", base, available_now=available_now), fn.state


def start_linreg(train: DataFrame, test: DataFrame, base: str,
                 model: StreamingLinearModel | None = None, available_now: bool = False):
    """Same for the regression: ``label`` and a ``features`` array with a value for each weight."""
    model = model or StreamingLinearModel.zeros(1)
    names = [f"x{i}" for i in range(len(model.weights))]
    parts = lambda df, role: df.select(
        "label", *[F.col("features")[i].alias(n) for i, n in enumerate(names)], F.lit(role).alias("role"))
    fn = linreg_foreach_batch(model, "label", names, f"{base}/model", role_col="role",
                              predict_dir=f"{base}/predictions")
    return _run(parts(train, "train").unionByName(parts(test, "test")), fn, "linreg", base,
                available_now=available_now), fn.state
