"""Sliding-window counts and top-k (AGG1, AGG2, SRT1, SRT2).

Two batch forms, both exact:

``sliding_sums`` (the step-function form): the relational image of an
invertible window reduce. The value changes only where a row arrives (its
tick) or leaves (one window later); the windowed value at each such tick is the
running sum of what arrived less what left. Output size is bounded by twice
the number of distinct (key, tick) pairs, however long the window is.

``window_counts``: one row per (window, key), equal to Spark's
``window(ts, W, S)``. Rows are first counted per slide bucket (a tumbling
pre-aggregate with map-side combine), and only those counts are copied into
the ``W/S`` windows that contain the bucket, so the copy factor applies to
distinct (bucket, key) pairs, not to raw rows.

Skew: a frame ordered by tick is one task per partition key, so the
step-function form partitions by (key, period) -- a day by default -- and
copies the last window of each period into the next one (halo rows). A key
that holds a third of all rows is split into as many tasks as it has periods.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.timecols import epoch_seconds


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    if isinstance(keys, str):
        return [keys]
    return list(keys)


def parse_seconds(d) -> int:
    """'300 seconds' / '1 hour' / '12 hours' / 300 -> seconds."""
    if isinstance(d, (int, float)):
        return int(d)
    n, unit = d.strip().split()
    unit = unit.lower().rstrip("s")
    mult = {"second": 1, "sec": 1, "minute": 60, "min": 60, "hour": 3600, "day": 86400,
            "week": 604800}[unit]
    return int(float(n) * mult)


def sliding_sums(df: DataFrame, keys, measures: Mapping[str, Column] | None = None,
                 time_col: str = "ts", window="300 seconds", tick="1 second",
                 period="1 day", keep_zero: bool = True) -> DataFrame:
    """Windowed sums as a step function per key.

    Output ``(*keys, tick, *measures)``: value of each measure over ticks
    ``(tick - window, tick]``, i.e. for rows with ``floor(t / tick_len) * tick_len``
    in that range. ``tick`` is epoch seconds of the tick start. A row appears
    wherever some measure changes (a row arrives or leaves the window); with
    ``keep_zero`` a key that leaves the window keeps a final all-zero row (as an
    add/subtract reduce without a filter function does), otherwise all-zero
    rows are dropped.

    Plan: (1) one aggregate per (key, tick) with map-side combine, fed with each
    row's measures at its tick and their negatives at tick + window; (2) one
    shuffle by (key, period) and a running sum of these changes in tick order.
    What the last ``window`` of a period added also opens the next period (halo
    rows), so a period needs no other one. The cost is a few rows per (key, tick)
    whatever the window's length; a key with a third of all rows is split into
    one task per period; no join, no per-key ordering.
    """
    keys = _keys(keys)
    measures = dict(measures or {"n": F.lit(1)})
    w_s, t_s, p_s = parse_seconds(window), parse_seconds(tick), parse_seconds(period)
    if w_s % t_s:
        raise ValueError("window must be a multiple of tick")
    p_s = -(-max(p_s, w_s) // t_s) * t_s  # whole ticks, at least one window long

    names = list(measures)
    tick_col = F.floor(epoch_seconds(time_col) / t_s) * t_s
    given = [m.cast("bigint") for m in measures.values()]
    nothing = F.lit(0).cast("bigint")
    rows = F.explode(F.array(
        F.struct(tick_col.alias("tick"), *[m.alias(k) for k, m in zip(names, given)],
                 *[m.alias(f"_in_{k}") for k, m in zip(names, given)]),
        F.struct((tick_col + w_s).alias("tick"), *[(-m).alias(k) for k, m in zip(names, given)],
                 *[nothing.alias(f"_in_{k}") for k in names]),
    )).alias("d")
    sums = [*names, *[f"_in_{k}" for k in names]]
    changes = (df.select(*keys, rows)
                 .select(*keys, "d.*")
                 .groupBy(*keys, "tick").agg(*[F.sum(k).alias(k) for k in sums]))

    home = F.floor(F.col("tick") / p_s)
    reach = F.floor((F.col("tick") + w_s) / p_s)
    some = lambda cs: F.greatest(*[c != 0 for c in cs]) if len(cs) > 1 else cs[0] != 0
    own = F.struct(home.alias("p"), F.col("tick").alias("at"), F.lit(True).alias("own"),
                   *[F.col(k) for k in names])
    opening = F.struct(reach.alias("p"), (reach * p_s - 1).alias("at"), F.lit(False).alias("own"),
                       *[F.col(f"_in_{k}").alias(k) for k in names])
    entered = some([F.col(f"_in_{k}") for k in names])
    seg = F.explode(F.when(entered & (reach != home), F.array(own, opening)).otherwise(F.array(own)))
    placed = (changes.select(*keys, seg.alias("_s"))
                     .select(F.struct(*[F.col(k) for k in keys], F.col("_s.p").alias("_period")).alias("_seg"),
                             F.col("_s.at").alias("tick"), F.col("_s.own").alias("_own"),
                             *[F.col(f"_s.{k}").alias(f"_d_{k}") for k in names]))
    w = Window.partitionBy("_seg").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    valued = placed.select("_seg", "tick", "_own", *[f"_d_{k}" for k in names],
                           *[F.sum(f"_d_{k}").over(w).alias(k) for k in names])
    out = (valued.where(F.col("_own") & some([F.col(f"_d_{k}") for k in names]))
                 .select(*[F.col("_seg")[k].alias(k) for k in keys], "tick", *names))
    if not keep_zero:
        out = out.where(F.greatest(*[F.col(k) != 0 for k in names]) if len(names) > 1
                        else F.col(names[0]) != 0)
    return out


def sliding_counts(df: DataFrame, key, time_col: str = "ts", window="300 seconds",
                   tick="1 second", keep_zero: bool = True, out: str = "n") -> DataFrame:
    """AGG1 (``keep_zero=True``) / AGG2 (``keep_zero=False``): windowed count per key."""
    return sliding_sums(df, key, {out: F.lit(1)}, time_col, window, tick, keep_zero=keep_zero)


def window_sums(df: DataFrame, keys, measures: Mapping[str, Column] | None = None,
                time_col: str = "ts", window="300 seconds", slide="1 second") -> DataFrame:
    """Sums per ``(window_start, window_end, *keys)`` equal to ``window(ts, W, S)``.

    Windows are ``[start, start + W)`` with ``start`` a multiple of ``S`` (epoch
    aligned, no offset); only windows holding at least one row appear. Times are
    epoch seconds. The output has up to ``W/S`` rows per (bucket, key); for a
    very fine slide :func:`sliding_sums` gives the same values as a step function
    without the copies.
    """
    keys = _keys(keys)
    measures = dict(measures or {"n": F.lit(1)})
    w_s, s_s = parse_seconds(window), parse_seconds(slide)
    if w_s % s_s:
        raise ValueError("window must be a multiple of slide")
    copies = w_s // s_s
    bucket = (F.floor(epoch_seconds(time_col) / s_s) * s_s).alias("_bucket")
    names = list(measures)
    # tumbling pre-aggregate: map-side combine before the first shuffle
    per_bucket = (df.select(*keys, bucket, *[m.cast("bigint").alias(k) for k, m in measures.items()])
                    .groupBy(*keys, "_bucket").agg(*[F.sum(k).alias(k) for k in names]))
    expanded = (per_bucket
                .select(*keys, *names, "_bucket",
                        F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_k"))
                .select(*keys, *names, (F.col("_bucket") - F.col("_k") * s_s).alias("window_start")))
    return (expanded.groupBy("window_start", *keys)
                    .agg(*[F.sum(k).alias(k) for k in names])
                    .withColumn("window_end", F.col("window_start") + w_s)
                    .select("window_start", "window_end", *keys, *names))


def window_counts(df: DataFrame, key, time_col: str = "ts", window="300 seconds",
                  slide="1 second", out: str = "n") -> DataFrame:
    return window_sums(df, key, {out: F.lit(1)}, time_col, window, slide)


def stream_window_counts(df: DataFrame, key, time_col: str = "ts", window="300 seconds",
                         slide="1 second", watermark: str | None = "10 minutes",
                         out: str = "n") -> DataFrame:
    """Streaming twin of :func:`window_counts` on Spark's ``window()``.

    Needs an event-time column of type TIMESTAMP; a watermark bounds the state.
    """
    keys = _keys(key)
    if watermark:
        df = df.withWatermark(time_col, watermark)
    w = F.window(time_col, f"{parse_seconds(window)} seconds", f"{parse_seconds(slide)} seconds")
    return (df.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias(out))
              .select(epoch_seconds("w.start").alias("window_start"),
                      epoch_seconds("w.end").alias("window_end"), *keys, out))


def top_k(df: DataFrame, k: int, partition_by: Iterable[str], score: str = "n",
          key: str = "key", ascending: bool = False, rank_col: str | None = "rank") -> DataFrame:
    """SRT1/SRT2: the k best rows per partition, ties broken by ``key`` ascending.

    ``row_number() <= k`` is planned with a partial WindowGroupLimit before the
    shuffle, so each map task forwards at most k rows per partition value and a
    hot window cannot flood one reducer.
    """
    order = [F.col(score).asc() if ascending else F.col(score).desc(), F.col(key).asc()]
    w = Window.partitionBy(*partition_by).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    if rank_col:
        return ranked.withColumnRenamed("_rank", rank_col)
    return ranked.drop("_rank")


def latest_top_k(df: DataFrame, k: int, score: str = "n", key: str = "key",
                 ascending: bool = False) -> DataFrame:
    """Top k rows overall (TakeOrderedAndProject: k rows per task, then merge)."""
    order = [F.col(score).asc() if ascending else F.col(score).desc(), F.col(key).asc()]
    return df.orderBy(*order).limit(k)


def first_n(df: DataFrame, n: int = 20, order=()) -> DataFrame:
    """SRT3: a preview of ``n`` rows; with ``order`` the rows are deterministic
    (TakeOrderedAndProject), without it any ``n`` rows, like ``show()``."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)
