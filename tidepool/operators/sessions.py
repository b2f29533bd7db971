"""Per-client sessions (STS1-STS4), batch and stream on the same mergeable parts.

``second_parts`` counts each client's requests per second and keeps the first
``n`` of that second. Everything else merges such parts: first per client and
hour, then per client, so a client with a third of all requests is spread over
as many tasks as it has hours, and what meets in its last task is a bounded
list per hour. The input is read once. Parts of one second may come in several
rows (one per micro-batch of a stream); merging them in any order gives the
same result, so late and unordered files do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.timecols import epoch_micros, epoch_seconds

# --- fixed values (the reference's session rules) ----------------------------
CLICKSTREAM_LENGTH = 10        # keep the first 10 urls per client
SESSION_GAP = "30 minutes"     # idle timeout
# -----------------------------------------------------------------------------
HOUR = 3600


def second_parts(visits: DataFrame, key: str = "ip", item: str = "url", order=("ts", "event_id"),
                 time_col: str = "ts", n: int = CLICKSTREAM_LENGTH) -> DataFrame:
    """``(key, second, requests, first_us, last_us, clicks)``; a row without a time has a NULL second.

    ``clicks``: the first ``n`` as (order..., item) structs. A group is what one
    client requests in one second.
    """
    ntz = dict(visits.dtypes)[time_col] == "timestamp_ntz"
    click = F.struct(*[F.col(c) for c in order], F.col(item).alias("item"))
    micros = epoch_micros(time_col, ntz)
    return (visits.groupBy(F.col(key).alias("key"), epoch_seconds(time_col).alias("second"))
                  .agg(F.count(F.lit(1)).alias("requests"), F.min(micros).alias("first_us"),
                       F.max(micros).alias("last_us"),
                       F.slice(F.array_sort(F.collect_list(click)), 1, n).alias("clicks")))


def _merged(n: int) -> list:
    first = F.slice(F.array_sort(F.flatten(F.collect_list("clicks"))), 1, n)
    return [F.sum("requests").alias("requests"), first.alias("clicks")]


def merge_first_clicks(parts: DataFrame, key: str = "ip", n: int = CLICKSTREAM_LENGTH) -> DataFrame:
    """``(key, session_length, clickstream)`` over all time."""
    hours = parts.groupBy("key", F.floor(F.col("second") / HOUR).alias("hour")).agg(*_merged(n))
    return (hours.groupBy("key").agg(*_merged(n))
                 .select(F.col("key").alias(key), F.col("requests").alias("session_length"),
                         F.col("clicks.item").alias("clickstream")))


def _united(rows: DataFrame, keys: list, start: str, length, n: int) -> DataFrame:
    """Spans (start, length) of a key that touch are one; ``(key, start_us, end_us, requests, clicks)``.

    The times are aggregates, not the window's fields: Spark would push a filter
    on a field below the aggregate, where it drops parts before they merge.
    """
    w = F.session_window(F.timestamp_micros(start), F.make_interval(secs=(length / 1_000_000).cast("decimal(18,6)")))
    times = [F.min(F.col(start)).alias("start_us"), F.max(F.col(start) + length).alias("end_us")]
    return (rows.groupBy(*keys, w.alias("s")).agg(*times, *_merged(n))
                .select("key", "start_us", "end_us", "requests", "clicks"))


def merge_pieces(pieces: DataFrame, n: int = CLICKSTREAM_LENGTH) -> DataFrame:
    """Pieces ``(key, start_us, end_us, requests, clicks)`` of sessions, each as long as its gap allows, as whole ones.

    Interval union is associative: the result does not depend on how the requests were dealt into pieces.
    """
    return _united(pieces, ["key"], "start_us", F.col("end_us") - F.col("start_us"), n)


def merge_gap_sessions(parts: DataFrame, key: str = "ip", gap: str = SESSION_GAP,
                       n: int = CLICKSTREAM_LENGTH) -> DataFrame:
    """``(key, start_us, end_us, requests, clicks)``: a session ends ``gap`` after its last request.

    Two passes of ``session_window``, per (key, hour) and per key, each part
    carrying its own length plus the gap, so touching or overlapping parts join.
    """
    from tidepool.operators.windows import parse_seconds

    gap_us = parse_seconds(gap) * 1_000_000
    timed = parts.where("second IS NOT NULL").withColumn("hour", F.floor(F.col("second") / HOUR))
    hourly = _united(timed, ["key", "hour"], "first_us", F.col("last_us") - F.col("first_us") + gap_us, n)
    return merge_pieces(hourly, n).withColumnRenamed("key", key)


def session_first_clicks(visits: DataFrame, key: str = "ip", item: str = "url",
                         order=("ts", "event_id"), n: int = CLICKSTREAM_LENGTH) -> DataFrame:
    """``(key, session_length, clickstream array)`` for every key (NULL key included)."""
    return merge_first_clicks(second_parts(visits, key, item, order, order[0], n), key, n)


def in_seconds(sessions: DataFrame, *more: str) -> DataFrame:
    """Times in epoch seconds; ``more`` columns behind them."""
    seconds = lambda c: F.floor(F.col(c) / 1_000_000).cast("bigint")
    return sessions.select(sessions.columns[0], seconds("start_us").alias("session_start"),
                           seconds("end_us").alias("session_end"), "requests", *more)


def gap_first_clicks(parts: DataFrame, key: str = "ip", gap: str = SESSION_GAP,
                     n: int = CLICKSTREAM_LENGTH) -> DataFrame:
    """``(key, session_start, session_end, requests, clickstream)``; times in epoch seconds."""
    merged = merge_gap_sessions(parts, key, gap, n)
    return in_seconds(merged.withColumn("clickstream", F.col("clicks.item")), "clickstream")


def gap_sessions(visits: DataFrame, key: str = "ip", time_col: str = "ts",
                 gap: str = SESSION_GAP) -> DataFrame:
    """``(key, session_start, session_end, requests)``; times in epoch seconds."""
    parts = second_parts(visits.withColumn("_none", F.lit(None).cast("string")), key, "_none", (time_col,), time_col, 0)
    return in_seconds(merge_gap_sessions(parts, key, gap, 0))


def open_sessions(parts: DataFrame, key: str = "ip", gap: str = SESSION_GAP,
                  n: int = CLICKSTREAM_LENGTH) -> DataFrame:
    """STS3: ``(key, session_length, clickstream)`` of the sessions still open at the last request of all."""
    now = parts.agg(F.max("last_us")).first()[0]  # one number
    return (merge_gap_sessions(parts, key, gap, n).where(F.col("end_us") > F.lit(now).cast("bigint"))
            .select(key, F.col("requests").alias("session_length"), F.col("clicks.item").alias("clickstream")))
