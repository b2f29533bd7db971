"""What streams with keyed state share: RocksDB, result rows by batch, and the state as a table.

A job's rows go to ``<base>/<rows>/batch_id=N`` (a replayed batch replaces its
own, a batch without rows leaves no folder); its state is read back with Spark's
state data source at a committed batch, so rows and state belong together.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.session import ship_code
from tidepool.streaming import runners

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class StateJob:
    """``schema``: of the rows that the job keeps."""

    def __init__(self, base: str, name: str, schema: str):
        self.base, self.name, self.schema = base.rstrip("/"), name, schema
        self.checkpoint, self.rows_path = f"{self.base}/checkpoint", f"{self.base}/rows"

    def _start(self, out: DataFrame, on_batch, available_now: bool, partitions: int | None) -> StreamingQuery:
        """``on_batch(rows, batch_id)`` gives what to keep of a batch's rows."""
        spark = out.sparkSession
        ship_code(spark)

        def run(batch_df: DataFrame, batch_id: int) -> None:
            batch_df = batch_df.persist()
            try:
                kept = on_batch(batch_df, batch_id)
                if not kept.isEmpty():
                    kept.write.mode("overwrite").parquet(f"{self.rows_path}/batch_id={batch_id}")
            finally:
                batch_df.unpersist()

        before = spark.conf.get(PROVIDER, None)
        spark.conf.set(PROVIDER, ROCKSDB)  # a query copies the settings when it starts
        try:
            return runners.start_foreach_batch(out, run, self.name, checkpoint=self.checkpoint, available_now=available_now, partitions=partitions)
        finally:
            spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)

    def committed(self, spark: SparkSession) -> int:
        """The last batch whose state is committed; -1 before the first."""
        last = spark.read.format("state-metadata").load(self.checkpoint).agg(F.max("maxBatchId")).first()[0]
        return -1 if last is None else last

    def state(self, spark: SparkSession, variable: str, batch_id: int) -> DataFrame:
        """A state variable after ``batch_id``."""
        return (spark.read.format("statestore").option("path", self.checkpoint).option("batchId", batch_id)
                .option("stateVarName", variable).load())

    def rows(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows of the batches up to ``batch_id``."""
        try:
            found = spark.read.schema(f"{self.schema}, batch_id int").parquet(self.rows_path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            found = spark.createDataFrame([], f"{self.schema}, batch_id int")  # nothing to keep so far
        return found.where(F.col("batch_id") <= batch_id)


def watermarked(df: DataFrame, time_col: str, delay: str, value, beat_col: str | None):
    """``df`` with a watermark that also heartbeats move, and ``value``, NULL for a heartbeat.

    ``value`` must hold the time, so that a filter on it stays above the watermark.
    """
    return df.withWatermark(time_col, delay), F.when(~F.col(beat_col), value) if beat_col else value


#: Rows that are packed at a time.
PACK = 100_000


def packed(rows: DataFrame, pack: Callable, schema: str) -> DataFrame:
    """One row a key for up to PACK rows of a partition, with lists: Python gets a row of a keyed state at a high price.

    ``pack`` makes a record batch of ``schema`` from a table of rows.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= PACK:
                yield pack(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield pack(pa.Table.from_batches(held))

    return rows.mapInArrow(run, schema)


def in_order(table, *columns: str):
    """A table with columns ``key`` and ``salt`` sorted by these and more, NULLs first, and which rows begin a new (key, salt)."""
    import pyarrow.compute as pc

    order = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in ("key", "salt", *columns)], null_placement="at_start")
    table = table.take(order).combine_chunks()
    key = table.column("key").combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    salt, new = table.column("salt").to_numpy(), np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
    return table, new


def lists(values, begins: np.ndarray, n: int):
    """``values`` cut into lists that begin at these places; ``n`` is where the last one ends."""
    import pyarrow as pa

    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array(np.append(begins, n).astype(np.int32)), values)

# Spark's Python workers on the driver don't get shipped files: what they need goes along by value.
register_pickle_by_value(sys.modules[__name__])
