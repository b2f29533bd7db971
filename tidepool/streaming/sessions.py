"""Streaming per-client sessions (STS1-STS4) on mergeable parts.

The stream stores each micro-batch's per-second parts under ``batch_id=N``
(:func:`tidepool.operators.sessions.second_parts`); nothing is kept in a state
store, no row is ever too late, and a replayed batch replaces its own parts.
Readers merge the parts: sessions split at idle gaps, clicks over all time, and
the snapshot of open sessions that the reference queries with SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepool.operators import sessions
from tidepool.operators.sessions import CLICKSTREAM_LENGTH, SESSION_GAP

# --- fixed values (the reference's snapshot view and query) -----------------
SNAPSHOT_VIEW = "sessionData"
SNAPSHOT_SQL = "select * from sessionData"
# -----------------------------------------------------------------------------


class SessionPartsSink:
    """``foreachBatch`` sink of visits (key, item, order columns) as per-second parts."""

    def __init__(self, path: str, key: str = "ip", item: str = "url", order=("ts", "event_id"),
                 time_col: str = "ts", n: int = CLICKSTREAM_LENGTH, gap: str = SESSION_GAP):
        self.path = path.rstrip("/")
        self.key, self.item, self.order, self.time_col, self.n, self.gap = key, item, order, time_col, n, gap

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        parts = sessions.second_parts(batch_df, self.key, self.item, self.order, self.time_col, self.n)
        parts.write.mode("overwrite").parquet(f"{self.path}/batch_id={int(batch_id)}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("batch_id")

    def first_clicks(self, spark: SparkSession) -> DataFrame:
        """STS1: count and first clicks of each client over all time."""
        return sessions.merge_first_clicks(self.read(spark), self.key, self.n)

    def gap_sessions(self, spark: SparkSession) -> DataFrame:
        """STS2: sessions split at the idle timeout, with their first clicks."""
        return sessions.gap_first_clicks(self.read(spark), self.key, self.gap, self.n)

    def snapshot(self, spark: SparkSession) -> DataFrame:
        """STS3: the open sessions; one that timed out is no longer in it."""
        return sessions.open_sessions(self.read(spark), self.key, self.gap, self.n)

    def snapshot_sql(self, spark: SparkSession, sql: str = SNAPSHOT_SQL, view: str = SNAPSHOT_VIEW) -> DataFrame:
        """STS4: SQL over the snapshot registered as ``sessionData``."""
        self.snapshot(spark).createOrReplaceTempView(view)
        return spark.sql(sql)
