"""Sessions as keyed state with timers (STS1-STS4): bounded state, closed by the watermark, exact however late rows come.

A processor per client keeps the open sessions only: when each began, its last
request, how many and the first 10 of them. A request joins every open session
it touches. Once the watermark passes a session's end, a timer emits it as a
closed piece and drops it from the state, which therefore does not grow with
history. Rows that come after that are not dropped: what touches no open session
and has timed out already is emitted as a late piece, counted on its own.

Pieces are mergeable: two that touch or overlap are one session, so closed, late
and open pieces merge to the same sessions as a batch over all rows, in
whatever order files came (:func:`merged`). For a key with a share of all
requests that one task can't carry, ``salts`` splits it into several states,
whose pieces merge the same way.

The open state is read back with Spark's state data source at a committed batch,
together with the pieces of the batches up to it.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import partial
from itertools import islice
from operator import itemgetter

import numpy as np
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidepool.operators import sessions
from tidepool.operators.sessions import CLICKSTREAM_LENGTH, SESSION_GAP
from tidepool.operators.windows import parse_seconds
from tidepool.streaming.state_job import StateJob, in_order, lists, packed, watermarked

WATERMARK = "10 minutes"
CLICKS = "click_us array<bigint>, click_id array<bigint>, click_item array<string>"
OPEN = f"start_us bigint, last_us bigint, requests bigint, {CLICKS}"
#: Pieces of a key as lists; ``clicks``: how many each has of the clicks.
FIRST = f"key string, salt int, start_us array<bigint>, last_us array<bigint>, requests array<bigint>, clicks array<bigint>, {CLICKS}"
#: Pieces of a key that are joined, and sessions that are written, at a time.
ROWS_AT_ONCE = 10_000
PIECE = f"key string, salt int, kind string, start_us bigint, end_us bigint, requests bigint, {CLICKS}"


class Sessions(StatefulProcessor):
    """Rows (pieces of a few requests) of a key -> pieces; the state holds its open sessions as one list, by their start.

    A micro-batch reads and writes a key's list once, and the key has one timer, for the session that ends first: what
    a row or a session costs is its share of a sort, not a call of the state store.
    """

    def __init__(self, gap_us: int, n: int, show_open: bool):
        self.gap_us, self.n, self.show_open = gap_us, n, show_open

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", OPEN)

    def _read(self) -> list[tuple]:
        """(start, last, requests, first clicks) of the open sessions."""
        return [(v[0], v[1], v[2], list(zip(v[3], v[4], v[5], strict=True))) for v in self.open.get()]

    def _first(self, clicks: list) -> list:
        return sorted(clicks, key=_place)[:self.n]

    def _joined(self, pieces: list[tuple]) -> list[tuple]:
        """Pieces less than a gap apart become one."""
        out: list[list] = []
        for start, last, requests, clicks in sorted(pieces, key=itemgetter(0, 1)):
            if out and start < out[-1][1] + self.gap_us:
                piece = out[-1]
                piece[1] = max(piece[1], last)
                piece[2] += requests
                piece[3] += clicks
                if len(piece[3]) > 8 * self.n + 64:  # a session may have any number of requests
                    piece[3] = self._first(piece[3])
            else:
                out.append([start, last, requests, [*clicks]])
        return [(s, e, m, self._first(c)) for s, e, m, c in out]

    def _united(self, pieces: list[tuple], rows) -> list[tuple]:
        """The pieces and those of the rows, joined; of the rows a part at a time."""
        fresh = []
        for r in rows:
            clicks = iter(zip(r.click_us, r.click_id, r.click_item, strict=True))
            fresh += [(s, e, m, [*islice(clicks, k)]) for s, e, m, k in zip(r.start_us, r.last_us, r.requests, r.clicks, strict=True)]
            if len(fresh) >= max(ROWS_AT_ONCE, len(pieces)):
                pieces, fresh = self._joined(pieces + fresh), []
        return self._joined(pieces + fresh)

    def _expiry(self, last: int) -> int:
        return -(-(last + self.gap_us) // 1000)

    def _piece(self, key: tuple, kind: str, start: int, last: int, requests: int, clicks: list) -> Row:
        us, ids, items = map(list, zip(*clicks, strict=True)) if clicks else ([], [], [])
        return Row(key=key[0], salt=key[1], kind=kind, start_us=start, end_us=last + self.gap_us, requests=requests,
                   click_us=us, click_id=ids, click_item=items)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self._read()
        watermark = timerValues.getCurrentWatermarkInMs()
        held = [p[0] for p in before]
        now = []
        for piece in self._united(before, rows):
            start, last, *_ = piece
            if self._expiry(last) <= watermark and bisect_left(held, start) == bisect_right(held, last):
                yield self._piece(key, "late", *piece)
            else:
                now.append(piece)
        self._write(now)
        due, then = self._due(before), self._due(now)
        if due != then:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(then)
        if self.show_open:
            yield from (self._piece(key, "open", *p) for p in now)

    def _due(self, pieces: list[tuple]) -> int | None:
        """When the first of them has timed out: the time of the key's timer."""
        return min((self._expiry(p[1]) for p in pieces), default=None)

    def _write(self, pieces: list[tuple]) -> None:
        values = [(s, e, m, *(map(list, zip(*c, strict=True)) if c else ([], [], []))) for s, e, m, c in pieces]
        if not values:
            self.open.clear()
            return
        self.open.put(values[:ROWS_AT_ONCE])
        for i in range(ROWS_AT_ONCE, len(values), ROWS_AT_ONCE):
            self.open.appendList(values[i:i + ROWS_AT_ONCE])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        left = []
        for piece in self._read():
            if self._expiry(piece[1]) <= watermark:
                yield self._piece(key, "closed", *piece)
            else:
                left.append(piece)
        self._write(left)
        if left:
            self.handle.registerTimer(self._due(left))

    def close(self) -> None:
        pass


def _place(click: tuple) -> tuple:
    """Order of clicks: time, id, item; NULLs first, as in Spark."""
    return tuple((x is not None, x) for x in click)


def _first_pieces(table, gap_us: int, n: int):
    """Rows (key, salt, us, id, item) -> of each key the pieces that they make, and all their clicks one after the other."""
    import pyarrow as pa

    table, new = in_order(table, "us", "id", "item")
    us = table.column("us").to_numpy()
    begin = new.copy()
    begin[1:] |= us[1:] >= us[:-1] + gap_us
    at = np.flatnonzero(begin)
    requests = np.diff(np.append(at, len(us)))
    place = np.arange(len(us)) - np.repeat(at, requests)
    first = np.flatnonzero(place < n)
    keys, begins = np.flatnonzero(new), np.flatnonzero(new[at])
    clicks = np.minimum(requests, n)
    columns = [table.column(c).take(pa.array(keys)).combine_chunks() for c in ("key", "salt")]
    columns += [lists(v, begins, len(at)) for v in (us[at], us[at + requests - 1], requests, clicks)]
    click_begins = (np.cumsum(clicks) - clicks)[begins]
    columns += [lists(table.column(c).take(pa.array(first)), click_begins, len(first)) for c in ("us", "id", "item")]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in FIRST.split(", ")])


def _clicks() -> F.Column:
    return F.transform(F.arrays_zip("click_us", "click_id", "click_item"), lambda c: F.struct(
        c["click_us"].alias("us"), c["click_id"].alias("id"), c["click_item"].alias("item")))


class SessionStateJob(StateJob):
    """A stream of visits (key, item, id and time columns) into ``base``: pieces, and the state in its checkpoint."""

    def __init__(self, base: str, key: str = "ip", item: str = "url", id_col: str = "event_id", time_col: str = "ts",
                 gap: str = SESSION_GAP, n: int = CLICKSTREAM_LENGTH, watermark: str = WATERMARK, salts: int = 1):
        super().__init__(base, "session_state", PIECE)
        self.key, self.item, self.id_col, self.time_col = key, item, id_col, time_col
        self.gap, self.n, self.watermark, self.salts = gap, n, watermark, salts

    def _pieces(self, visits: DataFrame, show_open: bool, beat_col: str | None) -> DataFrame:
        """The time goes in as a plain number, so Spark drops no late row; the watermark still drives the timers."""
        timed, us = watermarked(visits, self.time_col, self.watermark, F.unix_micros(self.time_col), beat_col)
        rows = timed.select(
            F.col(self.key).alias("key"), F.pmod(F.xxhash64(self.id_col), F.lit(self.salts)).cast("int").alias("salt"),
            us.alias("us"), F.col(self.id_col).cast("bigint").alias("id"), F.col(self.item).alias("item"))
        gap_us = parse_seconds(self.gap) * 1_000_000
        pieces = packed(rows.where("us IS NOT NULL"), partial(_first_pieces, gap_us=gap_us, n=self.n), FIRST)
        return pieces.groupBy("key", "salt").transformWithState(Sessions(gap_us, self.n, show_open), PIECE, "Append", "EventTime")

    def start(self, visits: DataFrame, on_batch=None, available_now: bool = False, partitions: int | None = None,
              beat_col: str | None = None) -> StreamingQuery:
        """``beat_col`` marks rows that hold only a time. ``on_batch(snapshot, batch_id)`` gets the open sessions after every micro-batch."""
        def run(batch_df: DataFrame, batch_id: int) -> DataFrame:
            if on_batch is not None:
                on_batch(self._now(batch_df, batch_id), batch_id)
            return batch_df.where("kind <> 'open'")

        return self._start(self._pieces(visits, on_batch is not None, beat_col), run, available_now, partitions)

    def _now(self, batch_df: DataFrame, batch_id: int) -> DataFrame:
        """Open sessions after this batch: those of the keys it had rows for, the state before it for all others,
        without what its timers have closed."""
        spark = batch_df.sparkSession
        now = batch_df.where("kind = 'open'").select(*_columns())
        if batch_id:
            now = now.unionByName(_without(self.open_pieces(spark, batch_id - 1), now, ["key", "salt"]))
        return self._sessions(_without(now, batch_df.where("kind = 'closed'"), ["key", "salt", "start_us"]))

    def open_pieces(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The state after ``batch_id``, through the state data source."""
        return self.state(spark, "open", batch_id).select("key.key", "key.salt", "list_element.*").withColumn(
            "end_us", F.col("last_us") + parse_seconds(self.gap) * 1_000_000).select(*_columns())

    def pieces(self, spark: SparkSession) -> DataFrame:
        """All pieces as of the last committed batch; each request is in one of them."""
        batch = self.committed(spark)
        return self.rows(spark, batch).select(*_columns()).unionByName(self.open_pieces(spark, batch))

    def late_requests(self, spark: SparkSession) -> int:
        """How many requests came after their session had timed out."""
        return self.rows(spark, self.committed(spark)).where("kind = 'late'").agg(F.coalesce(F.sum("requests"), F.lit(0))).first()[0]

    def _sessions(self, pieces: DataFrame) -> DataFrame:
        parts = pieces.select("key", "start_us", "end_us", "requests", _clicks().alias("clicks"))
        return sessions.merge_pieces(parts, self.n).withColumnRenamed("key", self.key)

    def sessions(self, spark: SparkSession) -> DataFrame:
        """``(key, session_start, session_end, requests, clickstream)``, like ``gap_first_clicks``."""
        return sessions.in_seconds(self._sessions(self.pieces(spark)).withColumn("clickstream", F.col("clicks.item")), "clickstream")

    def snapshot(self, spark: SparkSession) -> DataFrame:
        """STS3: ``(key, session_length, clickstream)`` of the sessions open at the last request of all."""
        merged = self._sessions(self.pieces(spark))
        last = merged.agg(F.max("end_us")).first()[0]
        now = (last if last is not None else 0) - parse_seconds(self.gap) * 1_000_000
        return merged.where(F.col("end_us") > now).select(
            self.key, F.col("requests").alias("session_length"), F.col("clicks.item").alias("clickstream"))


def _without(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys, NULL ones too, are not among the others'."""
    there = others.select(F.struct(*keys).alias("_there")).distinct()
    return rows.withColumn("_here", F.struct(*keys)).join(there, F.col("_here").eqNullSafe(F.col("_there")), "left_anti").drop("_here")


def _columns() -> list[str]:
    return ["key", "salt", "start_us", "end_us", "requests", "click_us", "click_id", "click_item"]

# Spark's Python workers on the driver don't get shipped files: what they need goes along by value.
register_pickle_by_value(sys.modules[__name__])
