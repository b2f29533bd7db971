"""Window operators against brute force: Spark's own window() and per-tick counts."""

from collections import Counter

from pyspark.sql import functions as F

from tidepool.operators import windows
from tidepool.sources import fixtures as fx

from conftest import SF_SMALL


def _events(spark):
    return fx.table(spark, SF_SMALL, "events").select("ts", F.col("event_type").alias("key"))


def test_window_counts_equal_spark_window(spark):
    ev = _events(spark)
    mine = windows.window_counts(ev, "key", "ts", "6 hours", "1 hour")
    w = F.window(F.col("ts").cast("timestamp"), "6 hours", "1 hour")
    ref = (ev.groupBy(w.alias("w"), "key").count()
             .select(F.unix_timestamp("w.start").alias("window_start"),
                     F.unix_timestamp("w.end").alias("window_end"), "key",
                     F.col("count").alias("n")))
    assert mine.exceptAll(ref).count() == 0 and ref.exceptAll(mine).count() == 0


def test_sliding_counts_step_function_brute_force(spark):
    ev = _events(spark)
    w = 3600
    steps = windows.sliding_counts(ev, "key", "ts", f"{w} seconds", "1 second", keep_zero=True).collect()
    secs = [(r["key"], r["s"]) for r in
            ev.select("key", F.unix_timestamp("ts").alias("s")).collect()]
    by_key = {}
    for r in steps:
        by_key.setdefault(r["key"], []).append((r["tick"], r["n"]))
    for key, pts in by_key.items():
        pts.sort()
        own = sorted(s for k, s in secs if k == key)
        for tick, n in pts:
            expect = sum(1 for s in own if tick - w < s <= tick)
            assert n == expect, (key, tick)
        assert pts[-1][1] == 0  # the key leaves the window with a zero row


def test_sliding_period_split_is_exact(spark):
    """Carried period totals give the same values whatever the period length."""
    ev = _events(spark)
    a = windows.sliding_sums(ev, "key", None, "ts", "2 hours", "1 second", period="1 day")
    b = windows.sliding_sums(ev, "key", None, "ts", "2 hours", "1 second", period="365 days")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sliding_null_keys_kept(spark):
    df = spark.createDataFrame([(None, "2024-01-01 00:00:00"), (None, "2024-01-01 00:00:01")],
                               "k string, t string").select("k", F.col("t").cast("timestamp_ntz").alias("ts"))
    out = windows.sliding_counts(df, "k", "ts", "10 seconds").orderBy("tick").collect()
    assert [(r["k"], r["n"]) for r in out] == [(None, 1), (None, 2), (None, 1), (None, 0)]


def test_top_k_ties_by_key(spark):
    df = spark.createDataFrame([(0, "b", 2), (0, "a", 2), (0, "c", 1), (1, "z", 5)],
                               "w int, key string, n long")
    got = windows.top_k(df, 2, ["w"], "n", "key").orderBy("w", "rank").collect()
    assert [(r["w"], r["key"], r["rank"]) for r in got] == [(0, "a", 1), (0, "b", 2), (1, "z", 1)]


def test_hashtag_counts_match_python(spark):
    from tidepool.functions import text as tx
    st = fx.statuses(spark, SF_SMALL)
    tags = Counter(r["tag"] for r in tx.hashtags(st, "text", "tag").collect())
    expect = Counter()
    for r in st.collect():
        parts = r["text"].rstrip(" ").split(" ")
        expect.update(p for p in parts if p.startswith("#"))
    assert tags == expect


def test_sliding_halo_at_every_boundary(spark):
    """Period as short as the window: every boundary needs halo rows."""
    ev = _events(spark)
    a = windows.sliding_sums(ev, "key", None, "ts", "2 hours", "1 second", period="2 hours")
    b = windows.sliding_sums(ev, "key", None, "ts", "2 hours", "1 second", period="365 days")
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fine_slides_are_not_refused(spark):
    """20,000 windows per row are legal; every one of them holds the row."""
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' as ts, 'a' as key")
    out = windows.window_counts(df, "key", "ts", "20000 seconds", "1 second")
    assert out.agg(F.count("*"), F.sum("n")).first() == (20000, 20000)


def test_dense_sliding_costs_the_same_for_any_window(spark):
    """A day with every second filled: a 3600 s window takes about as long as a 300 s one."""
    import time
    day = spark.range(86400).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("ts"),
                                    F.explode(F.array(*[F.lit(k) for k in "abcd"])).alias("key")).persist()
    day.count()

    def seconds(window):
        t = time.perf_counter()
        out = windows.sliding_counts(day, "key", "ts", f"{window} seconds")
        top, rows = out.agg(F.max("n"), F.count("*")).first()
        # the count rises for a window's length, then falls for one
        assert top == window and rows == 4 * 2 * window
        return time.perf_counter() - t

    seconds(300)
    short = min(seconds(300) for _ in range(2))
    assert min(seconds(3600) for _ in range(2)) < 3 * short + 1
    day.unpersist()
