"""Per-batch sinks (SNK1-SNK6) as ``foreachBatch`` functions and writers.

All of them are idempotent under replay of a micro-batch after a failure:
output paths and table versions are keyed by ``batch_id``, so re-running a
batch overwrites what the failed attempt may have left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.streaming import StreamingQueryListener

from tidepool.functions.text import utf16_length
from tidepool.streaming.files import RunningTotals
from tidepool.streaming.tiers import FAN, TieredParts


# ------------------------------------------------------------------ SNK1
def console(df: DataFrame, num_rows: int = 20, truncate: bool = False):
    """SNK1: a console writer (``show`` of each batch)."""
    return (df.writeStream.format("console").option("numRows", str(num_rows))
              .option("truncate", str(truncate).lower()))


# ------------------------------------------------------------------ SNK2
def json_nonempty(path: str, overwrite: bool = False):
    """SNK2: write each non-empty batch as JSON under ``batch_id=N``.

    With ``overwrite`` each batch replaces the one before at ``path`` itself, and
    only the last non-empty batch survives, as in the reference.
    """
    def run(batch_df: DataFrame, batch_id: int) -> None:
        batch_df = batch_df.persist()
        try:
            if not batch_df.isEmpty():
                to = path if overwrite else f"{path.rstrip('/')}/batch_id={int(batch_id)}"
                batch_df.write.mode("overwrite").json(to)
        finally:
            batch_df.unpersist()
    return run


# ------------------------------------------------------------- SNK3 + SNK4
class CaptureFull(Exception):
    """Raised by a capture whose limit was passed by an earlier batch: the query
    ends, and its checkpoint stays before the batch that was not saved."""


class TextCapture:
    """SNK3 + SNK4: save each non-empty batch as text under ``batch_id=N``.

    With a ``limit``, ``done`` turns true once more rows are saved; the caller
    then stops the query (:func:`tidepool.streaming.runners.drain_capture`; the
    reference exits the process instead). A batch that comes nevertheless raises
    ``CaptureFull`` and stays unread. The count is kept in ``<base>-count.json``,
    so a restarted query goes on counting. Batches are written with
    their natural partitioning; ``max_records_per_file`` bounds file sizes.
    """

    def __init__(self, base: str, limit: int | None = None, text_col: str = "text",
                 max_records_per_file: int | None = None):
        self.base, self.limit, self.text_col = base.rstrip("/"), limit, text_col
        self.max_records_per_file = max_records_per_file
        self.saved: RunningTotals | None = None

    @property
    def total(self) -> int:
        return self.saved.after[0] if self.saved else 0

    @property
    def done(self) -> bool:
        return self.limit is not None and self.total > self.limit

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        self.saved = self.saved or RunningTotals(spark, f"{self.base}-count.json", 1)
        before = self.saved.upto(batch_id)[0]  # of a replayed batch the old attempt does not count
        if self.limit is not None and before > self.limit:
            raise CaptureFull(f"{before} rows are saved")
        out = batch_df.select(F.col(self.text_col).cast("string").alias("value")).persist()
        try:
            n = out.count()
            if n == 0:
                return
            w = out.write.mode("overwrite")
            if self.max_records_per_file:
                w = w.option("maxRecordsPerFile", str(self.max_records_per_file))
            w.text(f"{self.base}/batch_id={batch_id}")
            self.saved.add(batch_id, [n])
        finally:
            out.unpersist()


def read_or_none(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet."""
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e) \
                or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


# ------------------------------------------------------------------ SNK5
class UpsertTable:
    """SNK5: keyed row store, last row per key wins (merge on read).

    A merge writes only the batch -- de-duplicated per key -- under
    ``delta/after=V/batch_id=N`` (overwrite: replaying a batch replaces its own
    output, nothing else), V being the newest base. Reading takes the last row
    per key, by the order columns and then the batch id, over that base and its
    deltas alone. ``row_number() = 1`` is planned with a limit below the shuffle,
    so a hot key sends one row per task. ``compact`` writes a new base; older
    bases and deltas are never listed again and may be deleted at any time.

    ``order`` should be total per key; ``format`` is any file format that Spark
    writes; ``rows_written`` counts the rows that merges of this object wrote.
    """

    def __init__(self, path: str, keys, order, compact_every: int | None = None, format: str = "parquet"):
        self.path = path.rstrip("/")
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.order = [order] if isinstance(order, str) else list(order)
        self.compact_every, self.format, self.rows_written = compact_every, format, 0

    @staticmethod
    def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
        return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")

    def _version(self, spark: SparkSession) -> int:
        """The newest complete base (its marker is written after it); -1 without one."""
        marks = read_or_none(spark, f"{self.path}/versions")
        return -1 if marks is None else marks.agg(F.max("covered")).first()[0]

    def merge(self, batch_df: DataFrame, batch_id: int) -> None:
        spark, seen = batch_df.sparkSession, Observation()
        # a replayed batch that the base already covers writes where no reader looks, or the same again
        to = f"{self.path}/delta/after={self._version(spark)}/batch_id={int(batch_id)}"
        delta = self.latest_per_key(batch_df, self.keys, self.order).observe(seen, F.count(F.lit(1)).alias("n"))
        delta.write.mode("overwrite").format(self.format).save(to)
        self.rows_written += seen.get["n"]
        if self.compact_every and batch_id > 0 and batch_id % self.compact_every == 0:
            self.compact(spark, batch_id)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        self.merge(batch_df, batch_id)

    def read_with_batch(self, spark: SparkSession) -> DataFrame | None:
        version = self._version(spark)
        deltas = read_or_none(spark, f"{self.path}/delta/after={version}", self.format)
        parts = [] if version < 0 else [spark.read.format(self.format).load(f"{self.path}/base/v={version}")]
        if deltas is not None:
            parts.append(deltas.withColumn("batch_id", F.col("batch_id").cast("bigint")))
        if not parts:
            return None
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return self.latest_per_key(rows, self.keys, [*self.order, "batch_id"])

    def read(self, spark: SparkSession) -> DataFrame | None:
        rows = self.read_with_batch(spark)
        return None if rows is None else rows.drop("batch_id")

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold the base and its deltas into base version ``upto`` (the last merged batch)."""
        rows = self.read_with_batch(spark)
        if rows is None or self._version(spark) >= upto:
            return
        rows.write.mode("overwrite").format(self.format).save(f"{self.path}/base/v={int(upto)}")
        spark.createDataFrame([(int(upto),)], "covered bigint").coalesce(1) \
             .write.mode("overwrite").parquet(f"{self.path}/versions/v={int(upto)}")


# -------------------------------------------- per-tick counts for sliding sums
class TickCountsSink:
    """Each micro-batch's sums per (key, tick), stored under ``batch_id=N``.

    The stream keeps no window state at all: a 300 s window sliding every
    second would hold 300 copies of every row in the state store. The exact
    step function is :func:`tidepool.operators.windows.sliding_sums` over these
    partial sums (``sliding``), and replaying a batch overwrites its own
    partition. ``measures`` maps output names to per-row values (default: a
    row count ``n``).
    """

    def __init__(self, path: str, keys, time_col: str = "ts", tick_s: int = 1,
                 measures: dict | None = None):
        self.path = path.rstrip("/")
        self.keys = [] if keys is None else ([keys] if isinstance(keys, str) else list(keys))
        self.time_col, self.tick_s = time_col, tick_s
        self.measures = measures or {"n": F.lit(1)}

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        tick = F.floor(F.unix_timestamp(F.col(self.time_col)) / self.tick_s) * self.tick_s
        sums = (batch_df.groupBy(*self.keys, tick.alias("tick"))
                        .agg(*[F.sum(m.cast("bigint")).alias(k) for k, m in self.measures.items()]))
        sums.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession, batch_ids=None) -> DataFrame:
        """All stored sums, or only those of ``batch_ids`` (no listing of the rest)."""
        if batch_ids is None:
            return spark.read.parquet(self.path).drop("batch_id")
        paths = [f"{self.path}/batch_id={int(b)}" for b in batch_ids]
        return spark.read.option("basePath", self.path).parquet(*paths).drop("batch_id")

    def sliding(self, spark: SparkSession, window="300 seconds", keep_zero: bool = True) -> DataFrame:
        from tidepool.operators.windows import sliding_sums
        sums = self.read(spark).withColumn("_t", F.timestamp_seconds("tick"))
        return sliding_sums(sums, self.keys, {k: F.col(k) for k in self.measures}, "_t", window,
                            f"{self.tick_s} seconds", keep_zero=keep_zero)


class TieredTickCounts(TickCountsSink):
    """``TickCountsSink`` whose parts are merged by tiers, for live jobs: a batch without rows leaves nothing, and
    the window's view opens the window's parts alone."""

    def __init__(self, path: str, keys, time_col: str = "ts", tick_s: int = 1, measures: dict | None = None,
                 window_s: int = 300, fan: int = FAN):
        super().__init__(path, keys, time_col, tick_s, measures)
        self.parts = TieredParts(self.path, self._merged, window_s, fan=fan)

    def _merged(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*self.keys, "tick").agg(*[F.sum(k).alias(k) for k in self.measures])

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        tick = F.floor(F.unix_timestamp(F.col(self.time_col)) / self.tick_s) * self.tick_s
        self.parts.append(batch_df.groupBy(*self.keys, tick.alias("tick")).agg(
            *[F.sum(m.cast("bigint")).alias(k) for k, m in self.measures.items()]), batch_id)

    def read(self, spark: SparkSession, batch_ids=None) -> DataFrame:
        """All stored sums."""
        return self.since(spark, None)

    def since(self, spark: SparkSession, tick: int | None) -> DataFrame:
        """The sums of the parts that hold ticks after ``tick``."""
        found = self.parts.read(spark, tick)
        if found is not None:
            return found
        columns = [*[f"{k} string" for k in self.keys], "tick bigint", *[f"{k} bigint" for k in self.measures]]
        return spark.createDataFrame([], ", ".join(columns))


# ------------------------------------------------------------------ SNK6
def text_metric_columns(text: str = "text") -> list:
    length = utf16_length(text)
    return [F.count(F.lit(1)).alias("tweets"), F.sum(length).alias("chars"),
            F.max(length).alias("longest")]


def observe_text_metrics(df: DataFrame, text: str = "text", name: str = "text_metrics"):
    """SNK6: attach counter/gauge metrics to a stream (or batch, via Observation).

    On a stream the metrics appear in each ``StreamingQueryProgress`` under
    ``observedMetrics[name]``; on a batch DataFrame an ``Observation`` is
    returned alongside.
    """
    if df.isStreaming:
        return df.observe(name, *text_metric_columns(text)), None
    obs = Observation(name)
    return df.observe(obs, *text_metric_columns(text)), obs


class MetricsListener(StreamingQueryListener):
    """Forwards observed metrics of ONE query to ``callback(name, batch_id, dict)``,
    keeping the running counter and average like the reference's gauges.

    ``totals_dir`` keeps the totals in one small file, so a restarted query goes
    on counting. The listener removes itself when its query ends.
    """

    def __init__(self, callback, name: str = "text_metrics", spark: SparkSession | None = None,
                 totals_dir: str | None = None):
        self.callback, self.name = callback, name
        self.spark, self.totals_dir, self.query_id = spark, totals_dir, None
        self.totals = RunningTotals(spark, f"{totals_dir}/totals.json", 2) if totals_dir else None
        self.last, self.before, self.after = -1, [0, 0], [0, 0]  # without a folder

    def watch(self, query) -> None:
        """Follow this query only."""
        self.query_id = str(query.id)

    @property
    def total_tweets(self) -> int:
        return (self.totals.after if self.totals else self.after)[0]

    @property
    def total_chars(self) -> int:
        return (self.totals.after if self.totals else self.after)[1]

    def _add(self, batch_id: int, figures: list[int]) -> None:
        if self.totals:
            self.totals.add(batch_id, figures)
        elif batch_id >= self.last:
            self.before = self.after if batch_id > self.last else self.before
            self.last, self.after = batch_id, [a + v for a, v in zip(self.before, figures, strict=True)]

    def onQueryStarted(self, event):  # noqa: N802 - Spark API
        if self.query_id is None and event.name and event.name.startswith(self.name):
            self.query_id = str(event.id)

    def onQueryProgress(self, event):  # noqa: N802
        if self.query_id is not None and str(event.progress.id) != self.query_id:
            return
        row = event.progress.observedMetrics.get(self.name)
        if row is None or not row["tweets"]:
            return
        batch_id = event.progress.batchId
        self._add(batch_id, [row["tweets"], row["chars"] or 0])
        self.callback(self.name, batch_id, {
            "counter": self.total_tweets,
            "avg_length": self.total_chars // self.total_tweets,
            "longest_in_batch": row["longest"],
        })

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        if self.spark is not None and str(event.id) == self.query_id:
            self.spark.streams.removeListener(self)
