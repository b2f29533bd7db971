"""Error-rate alarm over sliding windows (AGG2 + AGG4, SNK7).

Per window: success and failure totals; when ``success + failure > min_total``
the window is an ``alarm`` if ``failure / success > ratio`` and ``ok``
otherwise; below the volume floor it is ``quiet``. The ratio test is written
``failure > ratio * success`` so a window with no successes (ratio = +inf in
the reference's double division) alarms without dividing by zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.accesslog import parse_log, status_class, status_code
from tidepool.operators.windows import sliding_sums, window_sums

# --- fixed values (the reference's alarm rule) -------------------------------
MIN_TOTAL = 100      # alarm only when success + failure exceeds this
ALARM_RATIO = 0.5    # failure / success above this wakes someone up
ALARM_MESSAGE = "Wake somebody up! Something is horribly wrong."
ALL_CLEAR_MESSAGE = "All systems go."
# -----------------------------------------------------------------------------


def alarm_state(success: Column, failure: Column, min_total: int = MIN_TOTAL,
                ratio: float = ALARM_RATIO) -> Column:
    return (F.when(success + failure <= min_total, F.lit("quiet"))
             .when(failure > F.lit(ratio) * success, F.lit("alarm"))
             .otherwise(F.lit("ok")))


def _with_class(df: DataFrame, line: str | None, cls: str | None):
    """Input with a status-class column and the two conditional measures."""
    if cls is None:
        df = parse_log(df, line).withColumn("_class", status_class(status_code("log")))
        cls = "_class"
    klass = F.col(cls)
    return df, {"success": (klass == "Success").cast("int"),
                "failure": (klass == "Failure").cast("int")}


def error_rate_alarm(df: DataFrame, line: str | None = "line", class_col: str | None = None,
                     time_col: str = "ts", window="300 seconds", slide="1 second",
                     min_total: int = MIN_TOTAL, ratio: float = ALARM_RATIO) -> DataFrame:
    """``(window_start, window_end, success, failure, state)`` per non-empty window.

    Input is either raw log lines (``line``) or an existing status-class column.
    The class counts are conditional sums in one aggregation, never collected.
    """
    df, m = _with_class(df, line, class_col)
    w = window_sums(df, None, m, time_col, window, slide)
    return w.select("window_start", "window_end", "success", "failure",
                    alarm_state(F.col("success"), F.col("failure"), min_total, ratio).alias("state"))


def error_rate_alarm_ticks(df: DataFrame, line: str | None = "line", class_col: str | None = None,
                           time_col: str = "ts", window="300 seconds", tick="1 second",
                           min_total: int = MIN_TOTAL, ratio: float = ALARM_RATIO) -> DataFrame:
    """The same rule on every tick where the window totals change (+/- delta form).

    ``(tick, success, failure, state)``; the value at ``tick`` holds until the
    next row. This is the reference's 300 s / 1 s setting at any data volume.
    """
    df, m = _with_class(df, line, class_col)
    s = sliding_sums(df, None, m, time_col, window, tick, keep_zero=True)
    return s.select("tick", "success", "failure",
                    alarm_state(F.col("success"), F.col("failure"), min_total, ratio).alias("state"))


def alarm_messages(alarm: DataFrame) -> DataFrame:
    """SNK7: the totals line and the alarm / all-clear line for each window."""
    totals = F.concat(F.lit("Total success: "), F.col("success").cast("string"),
                      F.lit(" Total failure: "), F.col("failure").cast("string"))
    verdict = (F.when(F.col("state") == "alarm", F.lit(ALARM_MESSAGE))
                .when(F.col("state") == "ok", F.lit(ALL_CLEAR_MESSAGE)))
    return alarm.withColumn("totals_message", totals).withColumn("alarm_message", verdict)
