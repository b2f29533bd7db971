"""Sliding counts as keyed state (AGG1 live): a ring of the window's ticks for each key, shifted by timers.

The state of a key is its current count and a slot for each tick that still lies
in the window or ahead of the watermark. An event adds to its slot. Once the
watermark has passed a tick, the key's timer adds its slot to the count; one window
later it takes it out again and frees the slot. The slots lie in blocks of ticks, so
a micro-batch reads and writes a block once however many of its ticks change: a file
that holds years costs calls of the state store by its blocks, not by its rows. The
state is bounded by the window and the watermark's delay.

What comes out are the changes of the step function (``sliding_sums``), final as
of the watermark. A row whose tick is past already is not dropped but kept as a
late row; step functions add up, so keys with late rows are computed from their
arrivals, all others are read as they came. What lies ahead of the watermark is
read from the state store.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidepool.operators.windows import parse_seconds, sliding_sums
from tidepool.streaming.state_job import StateJob, in_order, lists, packed, watermarked

#: Ticks in one value of the state.
BLOCK = 10_000
#: A block: its ticks ascending, how many rows each has, and how many of the ticks are counted.
SLOTS = "ticks array<bigint>, n array<bigint>, counted int"
CHANGE = "key string, salt int, kind string, tick bigint, arrived bigint, gone bigint, n bigint"

_NONE = np.zeros(0, dtype=np.int64)


class Ring(StatefulProcessor):
    """Rows (ticks, n) of a key -> its ticks: rows that ``arrived`` and have ``gone``, and ``n`` in the window from then on.

    The slots lie in blocks of BLOCK ticks; in a block those that are counted come first, as the watermark passes ticks
    in their order. The key has one timer, for its next change.
    """

    def __init__(self, window: int, tick: int):
        self.window, self.tick = window, tick

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", "tick bigint", SLOTS)
        self.count = handle.getValueState("count", "n bigint, due_ms bigint")

    def _passed(self, tick: int) -> int:
        """When the watermark has passed a tick, in milliseconds."""
        return (tick + self.tick) * 1000

    def _last_passed(self, watermark: int) -> int:
        """The last second from which on a tick is ahead of the watermark."""
        return watermark // 1000 - self.tick

    def _block(self, begin: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ticks and counts of a block, and how many of them are counted."""
        found = self.slots.getValue((begin,))
        if found is None:
            return _NONE, _NONE, 0
        return np.array(found[0], dtype=np.int64), np.array(found[1], dtype=np.int64), found[2]

    def _keep(self, begin: int, ticks: np.ndarray, n: np.ndarray, counted: int) -> None:
        if len(ticks):
            self.slots.updateValue((begin,), (ticks.tolist(), n.tolist(), counted))
        else:
            self.slots.removeKey((begin,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self._last_passed(timerValues.getCurrentWatermarkInMs())
        ticks, counts, fresh = _NONE, _NONE, []
        for r in rows:
            fresh.append((np.array(r.ticks, dtype=np.int64), np.array(r.n, dtype=np.int64)))
            if sum(len(t) for t, _ in fresh) >= len(ticks):
                ticks, counts, fresh = *_summed(ticks, counts, fresh), []
        ticks, counts = _summed(ticks, counts, fresh)
        late = int(np.searchsorted(ticks, last, "right"))
        for tick, n in zip(ticks[:late].tolist(), counts[:late].tolist(), strict=True):
            yield Row(key=key[0], salt=key[1], kind="late", tick=tick, arrived=n, gone=0, n=None)
        ticks, counts = ticks[late:], counts[late:]
        if not len(ticks):
            return
        size = BLOCK * self.tick
        begins = ticks // size * size
        edges = [0, *(np.flatnonzero(begins[1:] != begins[:-1]) + 1).tolist(), len(ticks)]
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            begin = int(begins[i])
            old, n, counted = self._block(begin)
            pending = _summed(np.concatenate((old[counted:], ticks[i:j])), np.concatenate((n[counted:], counts[i:j])))
            self._keep(begin, np.concatenate((old[:counted], pending[0])), np.concatenate((n[:counted], pending[1])), counted)
        due, now = self._passed(int(ticks[0])), self.count.get()
        if now is None or due < now[1]:
            self._wait(now[0] if now else 0, due, now[1] if now else None)

    def _wait(self, n: int, due: int, before: int | None = None) -> None:
        """The key's count and its timer."""
        if before is not None:
            self.handle.deleteTimer(before)
        self.handle.registerTimer(due)
        self.count.update((n, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, size = self._last_passed(timerValues.getCurrentWatermarkInMs()), BLOCK * self.tick
        n, due = self.count.get()[0], []
        inside, inside_n = _NONE, _NONE  # counted, and still in the window
        begins = sorted(k[0] for k in self.slots.keys())
        for begin in [b for b in begins if b <= last]:
            ticks, counts, counted = self._block(begin)
            inside, inside_n = np.concatenate((inside, ticks[:counted])), np.concatenate((inside_n, counts[:counted]))
            upto = min(last, begin + size - 1)
            new = int(np.searchsorted(ticks, upto, "right"))
            gone = int(np.searchsorted(inside, upto - self.window, "right"))
            entering = ticks[counted:new], counts[counted:new]
            leaving = inside[:gone] + self.window, inside_n[:gone]
            inside, inside_n = np.concatenate((inside[gone:], entering[0])), np.concatenate((inside_n[gone:], entering[1]))
            more = int(np.searchsorted(inside, upto - self.window, "right"))  # came and went within the block
            leaving = np.concatenate((leaving[0], inside[:more] + self.window)), np.concatenate((leaving[1], inside_n[:more]))
            inside, inside_n = inside[more:], inside_n[more:]
            yield from self._changes(key, n, entering, leaving)
            n += int(entering[1].sum() - leaving[1].sum())
            out = int(np.searchsorted(ticks, last - self.window, "right"))
            if out or new > counted:
                self._keep(begin, ticks[out:], counts[out:], max(0, new - out))
            due += [self._passed(int(t)) for t in ticks[new:new + 1]]
        gone = int(np.searchsorted(inside, last - self.window, "right"))
        yield from self._changes(key, n, (_NONE, _NONE), (inside[:gone] + self.window, inside_n[:gone]))
        n -= int(inside_n[:gone].sum())
        due += [self._passed(int(t) + self.window) for t in inside[gone:gone + 1]]
        for begin in [b for b in begins if b > last][:1]:
            due.append(self._passed(int(self._block(begin)[0][0])))
        if due:
            self._wait(n, min(due))
        else:
            self.count.clear()  # a key that has been away for a window costs nothing

    def _changes(self, key: tuple, n: int, entering: tuple, leaving: tuple) -> Iterator[Row]:
        ticks = np.union1d(entering[0], leaving[0])
        arrived, gone = np.zeros(len(ticks), dtype=np.int64), np.zeros(len(ticks), dtype=np.int64)
        arrived[np.searchsorted(ticks, entering[0])] = entering[1]
        gone[np.searchsorted(ticks, leaving[0])] = leaving[1]
        for tick, a, g, m in zip(*(c.tolist() for c in (ticks, arrived, gone, n + np.cumsum(arrived - gone))), strict=True):
            yield Row(key=key[0], salt=key[1], kind="tick", tick=tick, arrived=a, gone=g, n=m)

    def close(self) -> None:
        pass


def _summed(ticks: np.ndarray, counts: np.ndarray, more=()) -> tuple[np.ndarray, np.ndarray]:
    """Each tick once, ascending, with the sum of its counts."""
    ticks, counts = np.concatenate((ticks, *(t for t, _ in more))), np.concatenate((counts, *(n for _, n in more)))
    each, at = np.unique(ticks, return_inverse=True)
    sums = np.zeros(len(each), dtype=np.int64)
    np.add.at(sums, at, counts)
    return each, sums


def _counted(table):
    """Rows (key, salt, tick) -> of each key its ticks and how many rows they have."""
    import pyarrow as pa

    table, new = in_order(table, "tick")
    tick = table.column("tick").to_numpy()
    each = new.copy()
    each[1:] |= tick[1:] != tick[:-1]
    at = np.flatnonzero(each)
    keys, begins = np.flatnonzero(new), np.flatnonzero(new[at])
    columns = [table.column(c).take(pa.array(keys)).combine_chunks() for c in ("key", "salt")]
    columns += [lists(v, begins, len(at)) for v in (tick[at], np.diff(np.append(at, len(tick))))]
    return pa.RecordBatch.from_arrays(columns, ["key", "salt", "ticks", "n"])


class SlidingStateJob(StateJob):
    """A stream of keyed rows into ``base``: changes of their sliding counts, the ring in the checkpoint's state."""

    def __init__(self, base: str, key: str, time_col: str = "ts", window="300 seconds", tick="1 second",
                 watermark: str = "10 seconds", salts: int = 1):
        super().__init__(base, "sliding_state", CHANGE)
        self.key, self.time_col, self.watermark, self.salts = key, time_col, watermark, salts
        self.window, self.tick = parse_seconds(window), parse_seconds(tick)

    def start(self, df: DataFrame, on_batch=None, available_now: bool = False, partitions: int | None = None,
              beat_col: str | None = None, id_col: str | None = None) -> StreamingQuery:
        """``on_batch(changes, batch_id)`` gets each micro-batch's changes (key, tick, n). ``salts`` deal a key's rows by ``id_col``."""
        tick = F.floor(F.unix_timestamp(self.time_col) / self.tick) * self.tick
        timed, tick = watermarked(df, self.time_col, self.watermark, tick, beat_col)
        salt = F.pmod(F.xxhash64(id_col), F.lit(self.salts)).cast("int") if id_col else F.lit(0)
        rows = timed.select(F.col(self.key).alias("key"), salt.alias("salt"), tick.cast("bigint").alias("tick")).where("tick IS NOT NULL")
        changes = packed(rows, _counted, "key string, salt int, ticks array<bigint>, n array<bigint>").groupBy("key", "salt").transformWithState(
            Ring(self.window, self.tick), CHANGE, "Append", "EventTime")

        def run(batch_df: DataFrame, batch_id: int) -> DataFrame:
            if on_batch is not None:
                on_batch(batch_df.where("kind = 'tick' AND arrived <> gone"), batch_id)
            return batch_df

        return self._start(changes, run, available_now, partitions)

    def _ahead(self, spark: SparkSession, batch: int) -> DataFrame:
        """Of every key the slots in the state, with what they will add and take."""
        blocks = self.state(spark, "slots", batch)
        slots = blocks.select("key.key", "key.salt", "user_map_value.counted", F.posexplode(F.arrays_zip("user_map_value.ticks", "user_map_value.n")))
        return slots.select("key", "salt", F.col("col.ticks").alias("tick"), F.col("col.n").alias("n"), (F.col("pos") < F.col("counted")).alias("counted"))

    def steps(self, spark: SparkSession) -> DataFrame:
        """``(key, tick, n)``: the exact step function of all rows that the last committed batch has seen."""
        batch = self.committed(spark)
        rows, ahead = self.rows(spark, batch), self._ahead(spark, batch)
        pending = ahead.where("NOT counted")
        # a key in several states, or with late rows, is summed up from its arrivals
        summed = rows.where("kind = 'late'" if self.salts == 1 else "true").select(F.struct("key").alias("k"))
        if self.salts > 1:
            summed = summed.union(pending.select(F.struct("key").alias("k")))
        summed = summed.distinct()

        def of(df: DataFrame, how: str) -> DataFrame:
            return df.withColumn("_k", F.struct("key")).join(summed, F.col("_k").eqNullSafe(F.col("k")), how).drop("_k")

        arrivals = of(rows.where("arrived > 0").select("key", "tick", F.col("arrived").alias("n")).unionByName(
            pending.select("key", "tick", "n")), "left_semi").withColumn("_t", F.timestamp_seconds("tick"))
        late = sliding_sums(arrivals, "key", {"n": F.col("n")}, "_t", f"{self.window} seconds", f"{self.tick} seconds")

        final = rows.where("kind = 'tick' AND arrived <> gone").select("key", "tick", "n")
        before = self.state(spark, "count", batch).select("key.key", F.col("value.n").alias("base"))
        coming = pending.select("key", "tick", F.col("n").alias("d")).unionByName(
            ahead.select("key", (F.col("tick") + self.window).alias("tick"), (-F.col("n")).alias("d")))
        coming = coming.groupBy("key", "tick").agg(F.sum("d").alias("d")).where("d <> 0")
        after = coming.join(before.withColumnRenamed("key", "k0"), F.col("key").eqNullSafe(F.col("k0")), "left")
        running = F.sum("d").over(Window.partitionBy("key").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0))  # one window's ticks
        after = after.select("key", "tick", (F.coalesce("base", F.lit(0)) + running).alias("n"))
        plain = final.unionByName(after)
        return of(plain, "left_anti").unionByName(late).withColumnRenamed("key", self.key)

# Spark's Python workers on the driver don't get shipped files: what they need goes along by value.
register_pickle_by_value(sys.modules[__name__])
