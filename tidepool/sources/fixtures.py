"""Inputs derived from the driver's tables.

No table holds access-log lines or status texts, so they are derived from
``events`` with column expressions: the derivation is a projection, it scales
with ``events`` and runs inside the scan's codegen stage. The same rules are
written as DuckDB SQL in :mod:`tidepool.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def log_line(events: DataFrame | None = None) -> Column:
    """The access-log line for one event row (see FIXTURES.md §4)."""
    eid, uid, etype, ts = F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("ts")
    request = (F.when(eid % 13 == 0, F.lit("GET"))
                .when(eid % 11 == 0, F.lit(""))
                .when(eid % 19 == 0, F.lit("GET /a b HTTP/1.1"))
                .otherwise(F.concat(F.lit("GET /"), etype, F.lit(" HTTP/1.1"))))
    status = (F.when(etype == "error", 500 + eid % 4)
               .when((etype == "view") & (F.dayofmonth(ts) % 5 == 0), F.lit(503))
               .when(etype == "signup", F.lit(302))
               .otherwise(F.lit(200)))
    ip = F.when(eid % 23 == 0, F.lit("")).otherwise(F.concat(F.lit("10.0.0."), _s(uid % 250)))
    good = F.concat(
        ip, F.lit(" - u"), _s(uid), F.lit(" ["), F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss"),
        F.lit(' +0000] "'), request, F.lit('" '), _s(status), F.lit(" "), _s(eid % 5000),
        F.lit(' "-" "agent-'), _s(eid % 7), F.lit('"'))
    return F.when(eid % 17 == 0, F.concat(F.lit("malformed "), _s(eid))).otherwise(good)


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, ts, user_id, line)``, one access-log line per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", "user_id", log_line().alias("line"))


def status_text() -> Column:
    eid, etype = F.col("event_id"), F.col("event_type")
    return F.concat(
        F.lit("#"), etype, F.lit(" the "),
        F.when(eid % 3 == 0, F.lit("My")).otherwise(F.lit("my")), F.lit(" "), etype,
        F.when(eid % 5 == 0, F.lit(" #")).otherwise(F.lit("")),
        F.lit(" #k"), _s(eid % 12),
        F.when(eid % 7 == 0, F.lit("  ")).otherwise(F.lit("")))


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, ts, text)``: short status texts with hashtags."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", status_text().alias("text"))


def vector_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``[value,user_id]`` text lines (the k-means training file format)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", "value", "user_id",
                     F.concat(F.lit("["), _s("value"), F.lit(","), _s("user_id"), F.lit("]")).alias("line"))


def labeled_point_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id%5,[value,user_id])`` text lines (the k-means test file format)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "ts", "value", "user_id",
        F.concat(F.lit("("), _s(F.col("event_id") % 5), F.lit(",["), _s("value"), F.lit(","),
                 _s("user_id"), F.lit("])")).alias("line"))
