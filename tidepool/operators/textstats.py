"""Text statistics (AGG5, AGG6, AGG9 over PRJ14/PRJ15).

Counts and lengths are aggregated per batch first (one partial aggregate per
task, one row per batch after the shuffle); the running figures over that
table come from :func:`tidepool.operators.batches.running`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import utf16_length
from tidepool.operators.batches import running

EXACT_DIGITS = 6


def text_length_stats(df: DataFrame, text: str = "text", by=()) -> DataFrame:
    """``n, total_chars, avg_length (floor, as the reference), exact_avg_length, longest``."""
    length = utf16_length(text)
    agg = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(length).alias("total_chars"),
        F.max(length).alias("longest"))
    return agg.select(
        *by, "n", "total_chars",
        F.expr("total_chars div n").alias("avg_length"),
        F.round(F.col("total_chars") / F.col("n"), EXACT_DIGITS).alias("exact_avg_length"),
        F.col("longest"))


def text_length_by_batch(df: DataFrame, text: str = "text", batch_col: str = "batch_id") -> DataFrame:
    """Per batch: the reference's gauges after that batch.

    ``n``/``chars``/``longest`` of the batch itself; ``total_n``/``total_chars``
    since the start; ``avg_length`` = total_chars div total_n (integer division,
    as in the reference) and ``exact_avg_length`` next to it; ``longest_all_time``
    as the extra all-time figure.
    """
    length = utf16_length(text)
    per = df.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("n"), F.sum(length).alias("chars"), F.max(length).alias("longest"))
    return running_text_length(per, batch_col)


def running_text_length(per: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """The running gauges over a table of (batch, n, chars, longest)."""
    out = running(per, batch_col, {"total_n": ("n", "sum"), "total_chars": ("chars", "sum"),
                                   "longest_all_time": ("longest", "max")})
    return (out.withColumn("avg_length", F.expr("total_chars div total_n"))
               .withColumn("exact_avg_length",
                           F.round(F.col("total_chars") / F.col("total_n"), EXACT_DIGITS)))
