"""Top-k over a fine sliding window as a step function (SRT1 + SRT2 at 300 s / 1 s).

The list of the k largest keys changes only where some key's count changes, so it
is given at those ticks only, not for every second. Time is cut into segments that
need nothing from each other: a segment begins with what the last window left
to each key, at the tick before its first (so that its first list can be compared
with the one before).

Within a segment most keys can't matter. A key that has a count of at least
``low`` throughout is a floor; if k keys hold their floors, a key whose highest
count stays below the k-th floor is in no list of the segment. Only the keys
above that bound are compared tick by tick.

Shuffles: counts per (key, tick), combined before; one by (segment, key) for the
running sums, the floors and highs; then only survivors move, by (segment, tick).
A hot key is split over ticks and segments, a hot segment over its keys; a
window holds one segment's ticks of one key, or k rows of one tick.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.timecols import epoch_seconds
from tidepool.operators.windows import parse_seconds

#: Segments of a window: short ones bound the keys' counts tightly, but each opens with all keys of the last window.
SEGMENTS = 5


def _segment_values(df: DataFrame, key: str, amount: Column, time_col: str, w: int, t: int, p: int) -> DataFrame:
    """(seg, key, at, n, until): each key's count from ``at`` on, within a segment and the tick before it."""
    tick = F.floor(epoch_seconds(time_col) / t) * t
    counts = df.groupBy(F.col(key).alias("key"), tick.alias("at")).agg(F.sum(amount.cast("bigint")).alias("c"))
    at, c = F.col("at"), F.col("c")
    change = lambda seg, when, d: F.struct(seg.alias("seg"), when.alias("at"), d.alias("d"))
    own, leave = change(F.floor(at / p), at, c), change(F.floor((at + w) / p), at + w, -c)
    first = (F.floor(at / p) + 1) * p
    starts = F.when(first <= at + w, F.sequence(first, at + w, F.lit(p).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    openings = F.transform(starts, lambda s: change(F.floor(s / p), s - t, c))
    rows = counts.select("key", F.explode(F.concat(F.array(own, leave), openings)).alias("r")).select("key", "r.*")
    keyed = Window.partitionBy("seg", "key").orderBy("at")
    return (rows.select("seg", "key", "at", F.sum("d").over(keyed.rangeBetween(Window.unboundedPreceding, 0)).alias("n"),
                        F.lead("at").over(keyed).alias("until"))
                .where(F.col("until").isNull() | (F.col("until") > F.col("at"))))  # the last of a tick's changes


def top_k_steps(df: DataFrame, key: str, k: int = 10, time_col: str = "ts", window="300 seconds", tick="1 second",
                segment=None, amount: Column | None = None) -> DataFrame:
    """``(tick, rank, key, n)``: the k largest keys over ticks ``(tick - window, tick]``, wherever that list changes.

    ``tick`` is epoch seconds; the list of any other time is that of the last
    tick before it. Ties go to the smaller key (NULL first). A list that has
    become empty is one row of rank 0 without a key. ``amount`` is what a row
    counts for, e.g. a stored partial count (default 1).
    """
    w, t = parse_seconds(window), parse_seconds(tick)
    if w % t:
        raise ValueError("window must be a multiple of tick")
    p = -(-(parse_seconds(segment) if segment else -(-w // SEGMENTS)) // t) * t  # whole ticks
    values = _segment_values(df, key, F.lit(1) if amount is None else amount, time_col, w, t, p)

    whole = Window.partitionBy("seg", "key")
    before = F.col("seg") * p - t
    low = F.when(F.min("at").over(whole) == before, F.min("n").over(whole)).otherwise(0)
    bounded = values.select("seg", "key", "at", "n", "until", F.max("n").over(whole).alias("high"), low.alias("low"))
    floors = bounded.groupBy("seg", "key").agg(F.max("low").alias("low")).where("low > 0")
    nth = F.row_number().over(Window.partitionBy("seg").orderBy(F.desc("low"), F.asc("key")))
    bound = floors.withColumn("nth", nth).where(F.col("nth") <= k).where(F.col("nth") == k).select(
        "seg", F.struct((-F.col("low")).alias("x"), "key").alias("bound"))
    place = F.struct((-F.col("high")).alias("x"), "key")
    survivors = bounded.join(bound, "seg", "left").where((F.col("high") > 0) & (F.col("bound").isNull() | (place <= F.col("bound"))))

    ticks = survivors.groupBy("seg").agg(F.sort_array(F.collect_set("at")).alias("ticks"))  # at most one for each tick of a segment
    held = F.filter("ticks", lambda x: (x >= F.col("at")) & (F.col("until").isNull() | (x < F.col("until"))))
    at_ticks = survivors.where("n > 0").join(ticks, "seg").select("seg", "key", "n", F.explode(held).alias("tick"))
    rank = F.row_number().over(Window.partitionBy("seg", "tick").orderBy(F.desc("n"), F.asc("key")))
    lists = (at_ticks.withColumn("rank", rank).where(F.col("rank") <= k).groupBy("seg", "tick")
             .agg(F.sort_array(F.collect_list(F.struct("rank", "key", "n"))).alias("list")))
    found = ticks.select("seg", F.explode("ticks").alias("tick")).join(lists, ["seg", "tick"], "left")
    last = F.lag("list").over(Window.partitionBy("seg").orderBy("tick"))
    changed = (found.withColumn("last", last)
               .where((F.col("tick") >= F.col("seg") * p) & ~F.col("list").eqNullSafe(F.col("last"))))
    row = F.explode_outer("list").alias("e")
    return changed.select("tick", row).select("tick", F.coalesce("e.rank", F.lit(0)).alias("rank"), F.col("e.key").alias(key),
                                              F.coalesce("e.n", F.lit(0).cast("bigint")).alias("n"))
