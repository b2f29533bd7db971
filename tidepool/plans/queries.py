"""Named queries over the driver's tables: one per capability of the reference.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` and reads the whole input
tables (or frames Spark derives from them). Times are epoch seconds (bigint)
so results do not depend on a session time zone; arrays that carry meaning in
their order are also given joined to a string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import accesslog as al
from tidepool.functions import text as tx
from tidepool.functions.vectors import parse_labeled_point, parse_vector
from tidepool.operators import alarm, batches, kmeans, linreg, sessions, textstats, topsteps, windows
from tidepool.sources import fixtures as fx

TOP_K = 10
# The reference slides 300 s windows every second; the test events are sparse
# (about one per 4 minutes at sf0.01), so the per-window top-k and the window
# alarm also run on day / 12-hour windows sliding by the hour. The step-function
# queries use the reference's 300 s / 1 s exactly.
TOPK_WINDOW, TOPK_SLIDE = "1 day", "1 hour"
ALARM_WINDOW, ALARM_SLIDE = "12 hours", "1 hour"
REF_WINDOW, REF_TICK = "300 seconds", "1 second"
BATCH_EVERY = "1 day"


# ---------------------------------------------------------------- log parsing
def log_parse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ1, PRJ4-PRJ6: every line parsed; row projection plus raw groups."""
    p = al.parse_log(fx.logs(spark, sf_dir), "line")
    return p.select(
        "event_id",
        F.col("log.matched").alias("matched"),
        al.matched_or("log", "ip").alias("ip"),
        al.url_loose().alias("url"),
        al.status_code().alias("status"),
        al.matched_or("log", "agent").alias("user_agent"),
        F.col("log.client").alias("client"),
        F.col("log.user").alias("user_name"),
        F.col("log.datetime").alias("log_time"),
        F.col("log.request").alias("request"),
        F.col("log.bytes").alias("bytes"),
        F.col("log.referer").alias("referer"),
    )


def log_url_strict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ2: strict url (3-token requests only) counted over all lines."""
    urls = al.to_strict_urls(fx.logs(spark, sf_dir), "line")
    return urls.groupBy("url").agg(F.count(F.lit(1)).alias("n"))


def log_url_leak_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ3: as PRJ2 but a bad request becomes the key ``()``."""
    urls = al.to_strict_urls(fx.logs(spark, sf_dir), "line", bad_request_label=al.LEAK_LABEL)
    return urls.groupBy("url").agg(F.count(F.lit(1)).alias("n"))


def log_status_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ8: status code (0 when unparseable) and its class, counted."""
    logs = fx.logs(spark, sf_dir)
    return (al.to_status_classes(logs, "line")
              .groupBy("status", "status_class").agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------ sliding windows
def url_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1 + PRJ16: strict-url counts over 300 s, every second, as a step function."""
    logs = al.to_strict_urls(fx.logs(spark, sf_dir), "line", keep=("ts",))
    return windows.sliding_counts(logs, "url", "ts", REF_WINDOW, REF_TICK, keep_zero=True)


def event_type_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1 on a plain key column: events by type over 300 s, every second."""
    ev = fx.table(spark, sf_dir, "events").select("ts", "event_type")
    return windows.sliding_counts(ev, "event_type", "ts", REF_WINDOW, REF_TICK, keep_zero=True)


def url_window_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT1/SRT2: top 10 strict urls per sliding window."""
    logs = al.to_strict_urls(fx.logs(spark, sf_dir), "line", keep=("ts",))
    counts = windows.window_counts(logs, "url", "ts", TOPK_WINDOW, TOPK_SLIDE)
    return windows.top_k(counts, TOP_K, ["window_start", "window_end"], "n", "url")


def status_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG2: count by status class over 300 s every second; zero counts dropped."""
    cls = al.to_status_classes(fx.logs(spark, sf_dir), "line", keep=("ts",))
    return windows.sliding_counts(cls, "status_class", "ts", REF_WINDOW, REF_TICK, keep_zero=False)


def error_rate_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG4 + SNK7 on 12-hour windows sliding by the hour."""
    logs = fx.logs(spark, sf_dir)
    return alarm.error_rate_alarm(logs, "line", None, "ts", ALARM_WINDOW, ALARM_SLIDE)


def error_rate_alarm_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG4 at the reference's 300 s / 1 s, on every tick where totals change."""
    logs = fx.logs(spark, sf_dir)
    return alarm.error_rate_alarm_ticks(logs, "line", None, "ts", REF_WINDOW, REF_TICK)


# ------------------------------------------------------------- per-batch SQL
def agent_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3 + AGG8: the reference's per-batch SQL, batches = days of event time."""
    logs = fx.logs(spark, sf_dir)
    records = batches.with_batch(al.to_records(logs, "line", keep=("ts",)), "ts", BATCH_EVERY)
    return batches.sql_per_batch(records)


# --------------------------------------------------------------------- texts
def hashtag_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ11/PRJ12 + AGG1: hashtag counts over 300 s every second."""
    tags = tx.hashtags(fx.statuses(spark, sf_dir), "text", "tag", keep=("ts",))
    return windows.sliding_counts(tags, "tag", "ts", REF_WINDOW, REF_TICK, keep_zero=True)


def hashtag_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's main job: top 10 hashtags per sliding window."""
    tags = tx.hashtags(fx.statuses(spark, sf_dir), "text", "tag", keep=("ts",))
    counts = windows.window_counts(tags, "tag", "ts", TOPK_WINDOW, TOPK_SLIDE)
    return windows.top_k(counts, TOP_K, ["window_start", "window_end"], "n", "tag")


def hashtag_topk_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main job at the reference's own setting: top 10 hashtags over 300 s, each second that the list changes."""
    tags = tx.hashtags(fx.statuses(spark, sf_dir), "text", "tag", keep=("ts",))
    return topsteps.top_k_steps(tags, "tag", TOP_K, "ts", REF_WINDOW, REF_TICK)


def url_topk_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT1/SRT2 of the log jobs: top 10 urls over 300 s, each second that the list changes."""
    urls = al.to_strict_urls(fx.logs(spark, sf_dir), "line", keep=("ts",))
    return topsteps.top_k_steps(urls, "url", TOP_K, "ts", REF_WINDOW, REF_TICK)


def word_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ13: top 10 non-stop words per sliding window (original case counted)."""
    words = tx.content_words(fx.statuses(spark, sf_dir), "text", "word", keep=("ts",))
    counts = windows.window_counts(words, "word", "ts", TOPK_WINDOW, TOPK_SLIDE)
    return windows.top_k(counts, TOP_K, ["window_start", "window_end"], "n", "word")


def text_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ14/PRJ15 + AGG5/AGG6/AGG9 over all conversation turns, per role."""
    conv = fx.table(spark, sf_dir, "conversations")
    return textstats.text_length_stats(conv, "text", by=("role",))


def text_length_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's gauges after each batch (days) of status texts."""
    st = batches.with_batch(fx.statuses(spark, sf_dir), "ts", BATCH_EVERY)
    return textstats.text_length_by_batch(st, "text", "batch_id")


def saved_rows_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG7 + SNK4: rows saved per daily batch until the total passes 100."""
    st = batches.with_batch(fx.statuses(spark, sf_dir), "ts", BATCH_EVERY)
    return batches.saved_rows_running_total(st, "batch_id")


# ------------------------------------------------------------------ sessions
def session_first10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ7 + STS1/STS3: requests and first 10 urls per client ip."""
    visits = al.to_visits(fx.logs(spark, sf_dir), "line", keep=("event_id", "ts"))
    s = sessions.session_first_clicks(visits, "ip", "url", ("ts", "event_id"))
    return s.select("ip", "session_length", F.size("clickstream").alias("clicks"),
                    F.concat_ws(" ", "clickstream").alias("clickstream"))


def session_gap_first10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STS1 + STS2: count and first 10 urls of each 30-minute session."""
    visits = al.to_visits(fx.logs(spark, sf_dir), "line", keep=("event_id", "ts"))
    out = sessions.gap_first_clicks(sessions.second_parts(visits))
    return out.select("ip", "session_start", "session_end", "requests", F.size("clickstream").alias("clicks"),
                      F.concat_ws(" ", "clickstream").alias("clickstream"))


def corpus_word_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ13 + SRT2 on real text: the 100 most frequent content words of documents and conversations."""
    texts = fx.table(spark, sf_dir, "documents").select("text").union(
        fx.table(spark, sf_dir, "conversations").select("text"))
    counts = tx.content_words(texts, "text", "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return windows.latest_top_k(counts, 100, "n", "word")


def records_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT3: the first 20 parsed records, as the console shows them."""
    records = al.to_records(fx.logs(spark, sf_dir), "line", keep=("event_id",))
    return windows.first_n(records, 20, ["event_id"])


def session_gap30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STS2: sessions per client ip split by 30 idle minutes."""
    visits = al.to_visits(fx.logs(spark, sf_dir), "line", keep=("event_id", "ts"))
    return sessions.gap_sessions(visits, "ip", "ts", sessions.SESSION_GAP)


# ---------------------------------------------------------------- text forms
def vector_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ9: ``[a,b]`` lines back to numbers."""
    v = fx.vector_lines(spark, sf_dir).select("event_id", parse_vector("line").alias("f"))
    return v.select("event_id", F.size("f").alias("dim"), F.col("f")[0].alias("f0"),
                    F.col("f")[1].alias("f1"))


def labeled_point_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ10: ``(label,[a,b])`` and legacy ``label,a b`` lines back to numbers."""
    lp = fx.labeled_point_lines(spark, sf_dir)
    tuple_form = lp.select("event_id", F.lit("tuple").alias("form"), "line")
    legacy_form = lp.select(
        "event_id", F.lit("legacy").alias("form"),
        F.concat((F.col("event_id") % 5).cast("string"), F.lit(","), F.col("value").cast("string"),
                 F.lit(" "), F.col("user_id").cast("string")).alias("line"))
    parsed = tuple_form.unionByName(legacy_form).select(
        "event_id", "form", parse_labeled_point("line").alias("p"))
    return parsed.select("event_id", "form", "p.label", F.col("p.features")[0].alias("f0"),
                         F.col("p.features")[1].alias("f1"), "p.parse_ok")


# ------------------------------------------------------------------- k-means
KMEANS_DIGITS = 6


def _kmeans_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", (F.col("event_id") % 5).cast("int").alias("label"),
                     F.array(F.col("value").cast("double"),
                             F.col("user_id").cast("double")).alias("features"))


def _first_centres(df: DataFrame, k: int) -> list[list[float]]:
    """Fixed start: the features of the k lowest event ids (k rows to the driver)."""
    rows = df.orderBy("event_id").limit(k).select("features").collect()
    return [list(r["features"]) for r in rows]


def kmeans_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML1: one streaming k-means update from zero-weight centres (= cluster means)."""
    df = _kmeans_input(spark, sf_dir)
    centres = _first_centres(df, kmeans.K)
    out = kmeans.batch_centres(df, "features", centres)
    return out.select("cluster", "n", *[F.round(f"c_{i}", KMEANS_DIGITS).alias(f"c_{i}")
                                        for i in range(kmeans.DIM)])


def kmeans_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML2: (label, cluster) for every point after the update."""
    df = _kmeans_input(spark, sf_dir)
    model = kmeans.StreamingKMeansModel.given(_first_centres(df, kmeans.K))
    model.train_batch(df, "features")
    return model.predict(df, "features").select("event_id", "label", "cluster")


def kmeans_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML1 over daily batches in order; the model after every batch."""
    from tidepool.streaming.ml import kmeans_replay
    df = batches.with_batch(_kmeans_input(spark, sf_dir), "ts", BATCH_EVERY)
    model = kmeans.StreamingKMeansModel.given(_first_centres(df, kmeans.K))
    out = kmeans_replay(df, "features", "batch_id", model)
    return out.select("batch_id", "cluster", "weight",
                      *[F.round(F.col("centre")[i], KMEANS_DIGITS).alias(f"c_{i}")
                        for i in range(kmeans.DIM)])


# ---------------------------------------------------------------- regression
REG_DIGITS = 6


def _regression_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fx.table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_shipdate",
                     (F.col("l_extendedprice") / 1000).alias("y"), F.col("l_quantity").alias("x"))


def linreg_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML3 building block: the batch moments (n, sums of y^2, x*y, y, x^2, x, 1)."""
    m = linreg.regression_moments(_regression_input(spark, sf_dir), "y", ["x"])
    return m.select(*[F.round(c, 2).alias(c) if c != "n" else F.col(c) for c in m.columns])


def linreg_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML5: least-squares slope and intercept (what SGD converges to)."""
    r = _regression_input(spark, sf_dir)
    return r.agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.regr_slope("y", "x"), REG_DIGITS).alias("slope"),
                 F.round(F.regr_intercept("y", "x"), REG_DIGITS).alias("intercept"))


def linreg_fit_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML5 far from zero: the fit on a feature shifted by 1e9, yearly parts of central co-moments merged."""
    r = _regression_input(spark, sf_dir).withColumn("x", F.col("x").cast("double") + 1e9)
    parts = linreg.centred_moments(batches.with_batch(r, "l_shipdate", "365 days"), "y", ["x"], ["batch_id"], [1e9, 0.0]).collect()
    whole = linreg.merged_moments([p.asDict() for p in parts], 1)
    slope = linreg.least_squares(whole, 1)[0][0]
    found = [(int(whole["n"]), round(float(slope), REG_DIGITS), round(float(whole["m"][1]), REG_DIGITS))]
    return spark.createDataFrame(found, "n bigint, slope double, mean_y double")


def linreg_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML4: (label truncated to int, prediction) per row with the fitted model."""
    r = _regression_input(spark, sf_dir)
    fit = r.agg(F.regr_slope("y", "x").alias("a"), F.regr_intercept("y", "x").alias("b")).first()
    pred = F.lit(fit["b"]) + F.lit(fit["a"]) * F.col("x")
    return r.select("l_orderkey", "l_linenumber", F.col("y").cast("int").alias("label"),
                    F.round(pred, REG_DIGITS).alias("prediction"))


def _linreg_sgd(spark: SparkSession, sf_dir: str, carry_intercept: bool) -> DataFrame:
    """Streaming SGD over yearly batches of lineitem (ship date order).

    The feature is standardized first (the step size assumes unit scale).
    """
    from tidepool.streaming.ml import linreg_replay
    r = _regression_input(spark, sf_dir)
    stats = r.agg(F.avg("x").alias("mu"), F.stddev_pop("x").alias("sd")).first()
    r = r.withColumn("xs", (F.col("x") - F.lit(stats["mu"])) / F.lit(stats["sd"] or 1.0))
    r = batches.with_batch(r, "l_shipdate", "365 days")
    out = linreg_replay(r, "y", ["xs"], "batch_id", linreg.StreamingLinearModel.zeros(1, carry_intercept=carry_intercept))
    return out.select("batch_id", "n", F.round(F.col("weights")[0], REG_DIGITS).alias("weight"),
                      F.round("intercept", REG_DIGITS).alias("intercept"))


def linreg_sgd_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML3: the intercept is carried from batch to batch like the weights."""
    return _linreg_sgd(spark, sf_dir, True)


def linreg_sgd_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML3 by the reference's rule: each batch starts again from intercept 1."""
    return _linreg_sgd(spark, sf_dir, False)


QUERIES = {
    "session_gap_first10": session_gap_first10,
    "corpus_word_topk": corpus_word_topk,
    "records_preview": records_preview,
    "linreg_sgd_reference": linreg_sgd_reference,
    "log_parse_records": log_parse_records,
    "log_url_strict_counts": log_url_strict_counts,
    "log_url_leak_counts": log_url_leak_counts,
    "log_status_class": log_status_class,
    "url_sliding_counts": url_sliding_counts,
    "event_type_sliding_counts": event_type_sliding_counts,
    "url_window_topk": url_window_topk,
    "status_sliding_counts": status_sliding_counts,
    "error_rate_alarm": error_rate_alarm,
    "error_rate_alarm_ticks": error_rate_alarm_ticks,
    "agent_batch_counts": agent_batch_counts,
    "hashtag_sliding_counts": hashtag_sliding_counts,
    "hashtag_topk": hashtag_topk,
    "hashtag_topk_ticks": hashtag_topk_ticks,
    "url_topk_ticks": url_topk_ticks,
    "word_topk": word_topk,
    "text_length_stats": text_length_stats,
    "text_length_by_batch": text_length_by_batch,
    "saved_rows_running_total": saved_rows_running_total,
    "session_first10": session_first10,
    "session_gap30": session_gap30,
    "vector_parse": vector_parse,
    "labeled_point_parse": labeled_point_parse,
    "kmeans_step": kmeans_step,
    "kmeans_predict": kmeans_predict,
    "kmeans_stream": kmeans_stream,
    "linreg_moments": linreg_moments,
    "linreg_fit": linreg_fit,
    "linreg_fit_shifted": linreg_fit_shifted,
    "linreg_predict": linreg_predict,
    "linreg_sgd_stream": linreg_sgd_stream,
}

from tidepool.plans.streams import STREAM_QUERIES  # noqa: E402

QUERIES.update(STREAM_QUERIES)
