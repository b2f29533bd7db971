"""Thin Structured Streaming runners: source -> operator -> sink.

Each runner takes a streaming DataFrame, applies an operator from
:mod:`tidepool.operators` and starts a query with its own checkpoint under the
shared folder (one per query; the reference shared one and never recovered).
``trigger`` defaults to the reference's one-second micro-batch; tests and
backfills pass ``available_now=True``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.operators.batches import BATCH_SQL, BATCH_VIEW
from tidepool.session import shared_dir

# --- fixed values (the reference's micro-batch intervals) --------------------
BATCH_INTERVAL = "1 second"
ROW_STORE_INTERVAL = "10 seconds"
# -----------------------------------------------------------------------------


def _trigger(writer, available_now: bool, interval: str):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def start_with_partitions(writer, spark, partitions: int | None = None) -> StreamingQuery:
    """``writer.start()``, with ``partitions`` shuffle and state partitions if given.

    The count is fixed for the life of a checkpoint at the first micro-batch.
    Without the argument the session's ``spark.sql.shuffle.partitions`` holds and
    nothing is changed; with it the setting is applied around ``start()`` only
    (a query copies the session's settings when it starts), so give it before
    other queries are planned in the same session.
    """
    if partitions is None:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def start_foreach_batch(df: DataFrame, fn, name: str, output_mode: str = "append",
                        available_now: bool = False, interval: str = BATCH_INTERVAL,
                        checkpoint: str | None = None,
                        partitions: int | None = None) -> StreamingQuery:
    """Run ``fn(batch_df, batch_id)`` on every micro-batch."""
    cp = checkpoint or shared_dir(df.sparkSession, f"checkpoint-{name}")
    # names must be unique among active queries: two jobs of one kind can run side by side
    w = (df.writeStream.queryName(f"{name}-{uuid.uuid4().hex[:8]}").outputMode(output_mode)
           .option("checkpointLocation", cp).foreachBatch(fn))
    return start_with_partitions(_trigger(w, available_now, interval), df.sparkSession, partitions)


def sql_each_batch(sql: str = BATCH_SQL, view: str = BATCH_VIEW, sink=None):
    """AGG3/STS4: register the micro-batch as ``view`` and run ``sql`` on it.

    The result gets the ``batch_id`` column and goes to ``sink(result, batch_id)``
    (default: append to nothing, i.e. show). The view is created on the batch's
    own session, as ``foreachBatch`` requires.
    """
    def run(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.createOrReplaceTempView(view)
        out = batch_df.sparkSession.sql(sql).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        if sink is None:
            out.show()
        else:
            sink(out, batch_id)
    return run


def append_parquet(path: str):
    """Per-batch append target for :func:`sql_each_batch`, keyed by batch id."""
    def sink(out: DataFrame, batch_id: int) -> None:
        out.drop("batch_id").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return sink


def drain(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query to finish; re-raise its failure.

    Without ``timeout_s`` it waits as long as the query runs. Past a timeout the
    query is stopped and ``TimeoutError`` raised: its sink is not complete.
    """
    if query.awaitTermination(timeout_s) is False:
        query.stop()
        raise TimeoutError(f"the query has not finished within {timeout_s} s; its sink is not complete")
    if query.exception():
        raise query.exception()


def drain_capture(query: StreamingQuery, capture, poll_s: float = 0.2) -> None:
    """Wait until the query ends or ``capture`` has its rows, then stop it.

    A batch that came after the limit is not saved and not acknowledged."""
    while not query.awaitTermination(poll_s):
        if capture.done:
            query.stop()
            return
    if query.exception() and "CaptureFull" not in str(query.exception()):
        raise query.exception()
