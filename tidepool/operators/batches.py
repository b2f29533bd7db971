"""Per-batch SQL, counts and running totals (AGG3, AGG7, AGG8, SNK4).

In a stream the batch is the micro-batch; replayed in batch mode it is a
tumbling bucket of event time, so the same operator gives the same rows.
Running figures over batches are summed in blocks of batches and in blocks of
blocks (:func:`running`), so no task holds all batches of a long-lived stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.timecols import epoch_seconds
from tidepool.operators.windows import parse_seconds

# --- fixed values (the reference's per-batch query and capture limit) --------
BATCH_SQL = "select agent, count(*) as total from requests group by agent"
BATCH_VIEW = "requests"
CAPTURE_LIMIT = 100   # stop saving after more than this many rows
# -----------------------------------------------------------------------------

# The same query over a replay, where every row carries its batch id.
BATCH_SQL_REPLAY = ("select batch_id, agent, count(*) as total from requests "
                    "group by batch_id, agent")


def batch_id(time_col: str = "ts", every="1 day"):
    """Replay batch id: index of the tumbling bucket holding the row."""
    return F.floor(epoch_seconds(time_col) / parse_seconds(every)).cast("bigint")


def with_batch(df: DataFrame, time_col: str = "ts", every="1 day", out: str = "batch_id") -> DataFrame:
    return df.withColumn(out, batch_id(time_col, every))


def sql_per_batch(df: DataFrame, sql: str = BATCH_SQL_REPLAY, view: str = BATCH_VIEW) -> DataFrame:
    """AGG3 over a replayed stream: the batch query with the batch column in it.

    ``df`` carries ``batch_id`` (see :func:`with_batch`), so grouping by it gives
    one result per batch in a single job. In a stream use
    :func:`tidepool.streaming.runners.sql_each_batch` with :data:`BATCH_SQL`.
    """
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)


BLOCK = 4096  # batches in a block, and blocks in a block of blocks


def running(per_batch: DataFrame, batch_col: str, figures: dict, block: int = BLOCK) -> DataFrame:
    """AGG7: adds running figures in batch order to a table of one row per batch.

    ``figures``: output name -> (column, "sum" or "max"). Each level aggregates
    blocks of ``block`` consecutive numbers of the level below; what lies before
    a batch is then the blocks before its own at each level. A window holds at
    most ``block`` rows, or one for each ``block`` ** 2 batches at the top.
    """
    of = {"sum": F.sum, "max": F.max}
    plus = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": F.greatest}
    blocks_of = [F.floor(F.col(batch_col) / block**i).cast("bigint") for i in (1, 2)]
    levels = [*blocks_of, F.pmod(blocks_of[1], F.lit(1))]  # all blocks of blocks are one group
    out = per_batch.withColumns({f"_l{i}": c for i, c in enumerate(levels)})
    inside = Window.partitionBy("_l0").orderBy(batch_col).rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns({name: of[kind](c).over(inside) for name, (c, kind) in figures.items()})
    sums = per_batch.withColumns({f"_l{i}": c for i, c in enumerate(levels)})
    blocks = {name: of[kind](c).alias(name) for name, (c, kind) in figures.items()}
    for i in (0, 1):
        keys = [f"_l{j}" for j in range(i, 3)]
        sums = sums.groupBy(*keys).agg(*blocks.values())
        earlier = Window.partitionBy(f"_l{i + 1}").orderBy(f"_l{i}").rowsBetween(Window.unboundedPreceding, -1)
        before = sums.select(f"_l{i}", *[of[kind](name).over(earlier).alias(f"_b_{name}") for name, (_, kind) in figures.items()])
        out = out.join(before, f"_l{i}").withColumns(
            {name: plus[kind](F.col(name), F.col(f"_b_{name}")) for name, (_, kind) in figures.items()}
        ).drop(*[f"_b_{name}" for name in figures])
        blocks = {name: of[kind](name).alias(name) for name, (_, kind) in figures.items()}
    return out.drop("_l0", "_l1", "_l2")


def saved_rows_running_total(df: DataFrame, batch_col: str = "batch_id",
                             limit: int = CAPTURE_LIMIT) -> DataFrame:
    """AGG7 + SNK4: rows saved per non-empty batch and the running total.

    Capture stops after the first batch that takes the total over ``limit``;
    batches after it are not saved (``saved = false``), nothing is dropped from
    the output so the cut point stays visible.
    """
    per = df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("rows"))
    run = running(per, batch_col, {"total_rows": ("rows", "sum")})
    return run.withColumn("saved", (F.col("total_rows") - F.col("rows")) <= limit)
