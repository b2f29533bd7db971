"""Keyed state over a large file: calls of the state store by blocks and keys, not by rows, and no more than linear work."""

import time
from types import SimpleNamespace

import pyarrow as pa
import pytest

from tidepool.streaming import session_state, sliding_state


class Handle:
    """The state and the timers of one key; every call is counted."""

    def __init__(self):
        self.calls, self.timers, self.values = 0, set(), {}

    def _count(self, value=None):
        self.calls += 1
        return value

    def registerTimer(self, at):
        self._count(self.timers.add(at))

    def deleteTimer(self, at):
        self._count(self.timers.remove(at))

    def getValueState(self, *_):
        return SimpleNamespace(get=lambda: self._count(self.values.get("value")), update=lambda v: self._count(self.values.update(value=v)),
                               clear=lambda: self._count(self.values.pop("value", None)))

    def getListState(self, *_):
        held = self.values.setdefault("list", [])
        return SimpleNamespace(get=lambda: self._count(list(held)), put=lambda v: self._count(held.__setitem__(slice(None), v)),
                               appendList=lambda v: self._count(held.extend(v)), clear=lambda: self._count(held.clear()))

    def getMapState(self, *_):
        held = self.values.setdefault("map", {})
        return SimpleNamespace(getValue=lambda k: self._count(held.get(k)), updateValue=lambda k, v: self._count(held.update({k: v})),
                               removeKey=lambda k: self._count(held.pop(k)), keys=lambda: self._count(list(held)),
                               iterator=lambda: self._count(list(held.items())), exists=lambda: self._count(bool(held)))


def run(processor, batch, watermarks):
    """Rows of one key at a watermark of 0, then the timers at each watermark -> its output, and the handle."""
    handle = Handle()
    processor.init(handle)
    at = lambda w: SimpleNamespace(getCurrentWatermarkInMs=lambda: w)
    out = list(processor.handleInputRows(("k", 0), iter(pa.Table.from_batches([batch]).to_pandas().itertuples(index=False)), at(0)))
    for w in watermarks:
        for timer in sorted(t for t in handle.timers if t <= w):
            out += processor.handleExpiredTimer(("k", 0), at(w), SimpleNamespace(getExpiryTimeInMs=lambda t=timer: t))
            handle.timers.discard(timer)
    return out, handle


@pytest.mark.parametrize("steps", [1, 7, 40])
def test_ring(steps):
    ticks = [100 + 37 * i % 50_021 for i in range(20_000)] * 2
    batch = sliding_state._counted(pa.table({"key": ["k"] * len(ticks), "salt": pa.array([0] * len(ticks), pa.int32()), "tick": ticks}))
    end = max(ticks) + 500
    out, handle = run(sliding_state.Ring(300, 1), batch, [1000 * end * (i + 1) // steps for i in range(steps)])
    changes: dict = {}
    for t in ticks:
        changes.setdefault(t, [0, 0])[0] += 1
        changes.setdefault(t + 300, [0, 0])[1] += 1
    n, want = 0, []
    for t, (arrived, gone) in sorted(changes.items()):
        n += arrived - gone
        want.append((t, arrived, gone, n))
    assert [(r.tick, r.arrived, r.gone, r.n) for r in out] == want
    assert not handle.timers and not handle.values["map"] and "value" not in handle.values
    assert handle.calls < 100 + 20 * steps


def test_sessions():
    us = [1_000_000_000 * i for i in range(5_000)] + [10**13 + 4_000_000_000 * i for i in range(5_000)]  # one that never rests; many of one
    table = pa.table({"key": ["k"] * len(us), "salt": pa.array([0] * len(us), pa.int32()), "us": us, "id": range(len(us)), "item": [None, "/"] * 5_000})
    batch = session_state._first_pieces(table, 1_800_000_000, 10)
    out, handle = run(session_state.Sessions(1_800_000_000, 10, False), batch, [10**10 + 10**9 * i for i in range(25)])
    assert [r.requests for r in out] == [5_000] + [1] * 5_000 and {r.kind for r in out} == {"closed"}
    assert out[0].click_id == list(range(10)) and not handle.timers and not handle.values["list"]
    assert handle.calls < 150


def test_a_long_session_is_joined_in_linear_time():
    of = session_state.Sessions(1_800_000_000, 10, False)
    pieces = [(i, i, 1, [(i, -i, None)]) for i in range(200_000)]
    begin = time.process_time()
    assert of._joined(pieces) == [(0, 199_999, 200_000, [(i, -i, None) for i in range(10)])]
    assert time.process_time() - begin < 20  # lists copied for every request took minutes
