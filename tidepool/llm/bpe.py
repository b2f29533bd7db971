"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each match of the split pattern is encoded on its own. Its bytes form a linked
list; every adjacent pair that joins to a vocabulary entry waits in the bucket
of its merge rank. A three-level bitmap over the ranks tells the lowest bucket
in use by find-first-set, so taking the next merge costs the same however long
the piece is. A bucket's merges are applied together, from the left where they
overlap. Entries whose pair has changed since are stale: they are recognised
when taken and skipped. The different pieces of a block of documents share one
list (with gaps between them) and one queue; their merges do not touch.

Spark deals the documents; a task works through blocks of bounded text. There
is no shuffle, and a lost task is simply run again.

Defined cases: a null or empty text has no tokens (digest of the empty string,
both columns); repeated rows and null ids give a row each; other columns of the
input are ignored, so their names cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame

from tidepool.llm.common import blocks, id_text, ship

#: A task merges the pieces of documents together up to this many characters of text.
BLOCK_CHARS = 4_000_000
#: Different new pieces in one linked list and queue.
MERGED_AT_ONCE = 100_000
#: A worker forgets the pieces it has met once it knows more than this many.
MEMO_PIECES = 300_000

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class RankQueue:
    """Positions by merge rank, in buckets under a three-level bitmap.

    ``push`` files arrays of positions under their ranks; ``pop`` finds the
    lowest rank in use by three find-first-set steps and gives its whole bucket.
    """

    def __init__(self, ranks: int):
        n0 = (ranks >> 6) + 1
        self.low = [0] * n0
        self.mid = [0] * ((n0 >> 6) + 1)
        self.top = 0
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        buckets = self.buckets
        for i, rank in enumerate(ranks[cuts[:-1]].tolist()):
            part = positions[cuts[i]:cuts[i + 1]]
            bucket = buckets.get(rank)
            if bucket is not None:
                bucket.append(part)
                continue
            buckets[rank] = [part]
            self.low[rank >> 6] |= 1 << (rank & 63)
            self.mid[rank >> 12] |= 1 << ((rank >> 6) & 63)
            self.top |= 1 << (rank >> 12)

    def pop(self) -> tuple[int, np.ndarray]:
        a = (self.top & -self.top).bit_length() - 1
        word = self.mid[a]
        b = (a << 6) + (word & -word).bit_length() - 1
        word = self.low[b]
        rank = (b << 6) + (word & -word).bit_length() - 1
        self.low[b] &= ~(1 << (rank & 63))
        if not self.low[b]:
            self.mid[a] &= ~(1 << (b & 63))
            if not self.mid[a]:
                self.top &= ~(1 << a)
        parts = self.buckets.pop(rank)
        return rank, parts[0] if len(parts) == 1 else np.concatenate(parts)

    def __bool__(self) -> bool:
        return self.top != 0


class _Numbered(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        got = self[key] = len(self)
        return got


class ByteBpe:
    """Encoder and decoder for one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.size = max(ranks.values(), default=0) + 1
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        # every way to join two entries to a third, by (left id, right id)
        pairs = [(ranks[b[:i]] * self.size + ranks[b[i:]], r) for b, r in ranks.items()
                 for i in range(1, len(b)) if b[:i] in ranks and b[i:] in ranks]
        pairs.sort()
        self.keys = np.array([k for k, _ in pairs] or [-1], dtype=np.int64)
        self.joined = np.array([r for _, r in pairs] or [-1], dtype=np.int64)
        # An id X = l + m with X + l at a lower rank than X: between two merges to X side by
        # side comes that lower one, so these are merged one by one.
        entry = {r: b for b, r in ranks.items()}
        self.early = {r for k, r in pairs
                      if ranks.get(entry[r] + entry[k // self.size], r) < r}
        self._forget()

    def _forget(self) -> None:
        """The pieces met so far by number, and for each how many ids, the ids as text, and their bytes."""
        self.known = _Numbered()
        self.counts: list[int] = []
        self.joined_ids: list[str] = []
        self.decoded: list[bytes] = []

    @classmethod
    def from_lines(cls, lines: bytes, pattern: str) -> ByteBpe:
        pairs = (x.split() for x in lines.splitlines() if x)
        return cls({base64.b64decode(a): int(b) for a, b in pairs}, pattern)

    def _joins(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; -1 where the two don't join."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.joined[at], -1)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece. All pieces lie in one linked list with gaps between."""
        out: list[list[int]] = [[]] * len(pieces)
        open_ = []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = [rank]
            elif piece:
                open_.append(i)
        if not open_:
            return out
        lengths = np.array([len(pieces[i]) for i in open_], dtype=np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join([pieces[i] for i in open_]), dtype=np.uint8)].astype(np.int32)
        n = len(ids)
        ends = np.cumsum(lengths)
        after = np.arange(1, n + 2, dtype=np.int32)  # n: no next one
        before = np.arange(-1, n, dtype=np.int32)
        after[ends - 1] = n
        before[(ends - lengths)] = n
        live = np.ones(n, dtype=bool)
        waiting = np.full(n + 1, -1, dtype=np.int32)  # rank of the pair that starts here
        at = np.flatnonzero(after[:n] < n)
        waiting[at] = self._joins(ids[at], ids[at + 1])
        at = at[waiting[at] >= 0]
        queue = RankQueue(self.size)
        queue.push(waiting[at], at)
        while queue:
            rank, at = queue.pop()
            at = at[waiting[at] == rank]  # the others are stale
            if not len(at):
                continue
            if len(at) > 1:
                at = np.sort(at)
                at = at[np.concatenate(([True], at[1:] != at[:-1]))]
                if rank in self.early:
                    near = (after[at[:-1]] == at[1:]) | (after[after[at[:-1]]] == at[1:])
                    first = np.concatenate(([True], ~near))
                    queue.push(np.full(int((~first).sum()), rank), at[~first])
                    at = at[first]
                else:  # of pairs that overlap, every other one from the left
                    first = np.concatenate(([True], after[at[:-1]] != at[1:]))
                    if not first.all():
                        steps = np.arange(len(at))
                        run = np.maximum.accumulate(np.where(first, steps, 0))
                        at = at[(steps - run) % 2 == 0]
            gone = after[at]
            follow = after[gone]
            after[at] = follow
            live[gone] = False
            waiting[gone] = -1
            before[follow[follow < n]] = at[follow < n]
            ids[at] = rank
            ahead = before[at]
            left = np.concatenate((ahead[ahead < n], at[follow < n]))
            waiting[at[follow == n]] = -1
            got = self._joins(ids[left], ids[after[left]])
            waiting[left] = got
            queue.push(got[got >= 0], left[got >= 0])
        ids = ids[live]
        kept = np.cumsum(live)[ends - 1]
        flat, start = ids.tolist(), 0
        for i, end in zip(open_, kept.tolist(), strict=True):
            out[i] = flat[start:end]
            start = end
        return out

    def numbered(self, texts: list[str]) -> list[list[int]]:
        """The pieces of each text as numbers into ``counts``, ``joined_ids`` and ``decoded``."""
        if len(self.known) > MEMO_PIECES:
            self._forget()
        number = self.known.__getitem__
        found = [list(map(number, self.find(t))) for t in texts]
        new = list(islice(reversed(self.known), len(self.known) - len(self.counts)))[::-1]
        for start in range(0, len(new), MERGED_AT_ONCE):
            for ids in self.merge([s.encode() for s in new[start:start + MERGED_AT_ONCE]]):
                self.counts.append(len(ids))
                self.joined_ids.append(",".join(map(str, ids)))
                self.decoded.append(self.decode(ids))
        return found

    def encode(self, text: str) -> list[int]:
        return [int(i) for c in self.numbered([text])[0] for i in self.joined_ids[c].split(",")]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_LOADED: dict[tuple[int, str], ByteBpe] = {}


def _loaded(lines: bytes, pattern: str) -> ByteBpe:
    """The worker's coder; kept between tasks, one at a time."""
    key = (hash(lines), pattern)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBpe.from_lines(lines, pattern)
    return _LOADED[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every whole text, decode the ids again, and digest both.

    The rank file (under 1 MB, a fixed vocabulary) is read on the driver and
    broadcast. ``with_ids`` adds the ids themselves (``ids array<int>``).
    """
    spark = docs.sparkSession
    ship(spark)
    with open(ranks_path, "rb") as f:
        lines = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        gc.disable()  # many small lists, no cycles
        coder = _loaded(lines.value, pattern)
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:4 + with_ids]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())][:4 + with_ids]
        for batch in batches:
            for ids, texts in blocks(batch, BLOCK_CHARS):
                found = coder.numbered(texts)
                rows = []
                for codes in found:
                    joined = ",".join([coder.joined_ids[c] for c in codes])
                    decoded = b"".join([coder.decoded[c] for c in codes])
                    row = [sum([coder.counts[c] for c in codes]), hashlib.sha256(joined.encode()).hexdigest(),
                           hashlib.sha256(decoded).hexdigest()]
                    rows.append([*row, [int(i) for i in joined.split(",") if i]] if with_ids else row)
                columns = [ids, *map(list, zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA + ", ids array<int>" * with_ids)
