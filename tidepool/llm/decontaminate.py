"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

Question: for which documents and benchmark items is there a window of as many
words as the item has, at a word edit distance of at most a fifth of them?
Words are runs of letters and digits, ASCII case folded.

Method, for every document in one pass over its words, without a shuffle:

* item-sized windows: for each item length n, every start at which a window of
  n words begins. An edit spoils at most two pairs of neighbouring words, so a
  window that holds fewer different pairs of the benchmark than an item has, less
  two for each edit, cannot be near it and is passed over (exact, no near window
  is lost);
* CGK embedding: a random walk over the window emits its words; word by word a
  shared random bit decides whether to step on. Windows at a small edit distance
  get embeddings at a small Hamming distance, since the walks meet again;
* bit sampling: each of several walks is sampled at several sets of positions;
  the samples of a set make a key. Windows and items that share a key are
  candidates;
* the word edit distance of every candidate is computed exactly (banded).

Walks over long items drift apart, so an item of LONG words or more is searched by
its pieces of about PIECE words: of a near window at least one piece has no more
than its share of the edits. Where a piece is near, the whole item is aligned to
the words around, and the item-sized windows at that place are measured.

Only the exact distance decides, so no pair is reported wrongly; how many near ones
the keys reach is measured in the tests (exact copies: all, by construction).

The benchmark is held by every task in blocks of at most BLOCK_WORDS words; a
larger benchmark takes a pass over the documents for each block, one after the
other. Windows wait for their keys up to WAITING bytes.

Defined cases: null or empty texts and items without words match nothing;
repeated documents and null ids are judged row by row; repeated items each;
items longer than a document cannot match it; extra columns are ignored by
``contaminated_pairs`` and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import textvec
from tidepool.llm.common import ship, written

_U = np.uint64
#: Most edits in fifths: a window is near at up to n // EDIT_SHARE edits (similarity 0.8).
EDIT_SHARE = 5
#: Walks, sample sets of each, and positions in a set.
WALKS, SETS, SAMPLES = 10, 8, 4
#: Most words of the benchmark in a task at once.
BLOCK_WORDS = 4_000_000
#: Items of so many words are searched by pieces of about so many.
LONG, PIECE = 64, 40
#: Bytes of windows that wait to be keyed together.
WAITING = 32_000_000
#: A pair seen again within so many words counts once.
RECENT = 6
_SEED = 0x5EED


class Index:
    """One block of the benchmark: its word pairs, and its items by their sampled keys."""

    def __init__(self, items: list[tuple[int, str]]):
        words = [(i, textvec.hashes_of(t or "", textvec.PUNCTUATION, True)) for i, t in items]
        self.whole = [(i, w) for i, w in words if len(w)]
        # what windows are compared with: an item, or a piece of one from its word ``offset`` on
        pieces = [(k, o, w[o:e]) for k, (_, w) in enumerate(self.whole) for o, e in _cuts(len(w))]
        self.of, self.offset = [p[0] for p in pieces], [p[1] for p in pieces]
        self.items = [(k, w) for k, _, w in pieces]
        self.pairs = np.unique(np.concatenate([_pairs(w) for _, w in self.items] or [np.zeros(0, dtype=_U)]))
        self.bits = np.zeros(1 << 22, dtype=bool)
        self.bits[self.pairs >> _U(42)] = True
        self.lengths = sorted({len(w) for _, w in self.items})
        # the fewest different known pairs of a window near an item of this length
        self.least = {n: min(len(np.unique(_pairs(w))) for _, w in self.items if len(w) == n) - 2 * (n // EDIT_SHARE)
                      for n in self.lengths}
        keys, owners = [], []
        for n in self.lengths:
            own = [k for k, (_, w) in enumerate(self.items) if len(w) == n]
            got = window_keys(np.stack([self.items[k][1] for k in own]))
            keys.append(got.ravel())
            owners.append(np.repeat(own, got.shape[1]))
        self.keys = np.concatenate(keys or [np.zeros(0, dtype=_U)])
        self.key_bits = np.zeros(1 << 22, dtype=bool)
        self.key_bits[self.keys >> _U(42)] = True
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.owners = self.keys[order], np.concatenate(owners or [np.zeros(0, dtype=int)])[order]

    def known(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """At which words a pair begins that the benchmark holds; where it is also not among the RECENT before."""
        pairs = _pairs(words)
        out = self.bits[pairs >> _U(42)]
        at = np.flatnonzero(out)
        place = np.searchsorted(self.pairs, pairs[at])
        place[place == len(self.pairs)] = 0
        out[at] = self.pairs[place] == pairs[at]
        fresh = out.copy()
        for back in range(1, min(RECENT, len(pairs) - 1) + 1):
            fresh[back:] &= pairs[back:] != pairs[:-back]
        return np.append(out, False), np.append(fresh, False)


def _cuts(n: int) -> list[tuple[int, int]]:
    """Begins and ends of the pieces of an item of ``n`` words."""
    parts = max(1, n // PIECE) if n >= LONG else 1
    edges = [n * i // parts for i in range(parts + 1)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _pairs(words: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return textvec.mix(words[:-1] * _U(0x9DDFEA08EB382D69) + words[1:])


def _plan(n: int) -> tuple[int, np.ndarray]:
    """Steps of a walk over n words and the sampled steps, (SETS, SAMPLES), the same for each walk."""
    steps = 2 * n
    rng = np.random.default_rng([_SEED, n])
    return steps, np.sort(rng.integers(0, steps, size=(SETS, SAMPLES)), axis=1)


def window_keys(windows: np.ndarray) -> np.ndarray:
    """(windows, WALKS * SETS) keys of windows given as a matrix of words; all walks step together."""
    m, n = windows.shape
    steps, samples = _plan(n)
    last = int(samples.max()) + 1
    wanted: dict[int, list[int]] = {}
    for s, row in enumerate(samples):
        for step in row.tolist():
            wanted.setdefault(step, []).append(s)
    padded = np.concatenate((windows, np.zeros((m, 1), dtype=_U)), axis=1).ravel()  # a walk stays at its end
    begin = (np.arange(m) * (n + 1))[:, None]
    at = np.zeros((m, WALKS), dtype=np.int64)
    with np.errstate(over="ignore"):
        salts = textvec.mix(np.arange(last * WALKS, dtype=_U) + _U(1)).reshape(last, WALKS) | _U(1)
        keys = np.empty((m, WALKS, SETS), dtype=_U)
        keys[:] = _U(n)
        for step in range(last):
            here = padded[begin + at]
            for s in wanted.get(step, ()):
                acc = (keys[:, :, s] ^ here) * _U(0x9DDFEA08EB382D69)
                keys[:, :, s] = acc ^ (acc >> _U(29))
            at += (at < n) & ((here * salts[step]) >> _U(63) == 1)
        keys += np.arange(WALKS * SETS, dtype=_U).reshape(WALKS, SETS) * _U(0x9E3779B97F4A7C15)
        return textvec.mix(keys).reshape(m, WALKS * SETS)


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Word edit distance of two sequences, or ``most`` + 1 if it is larger."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    if n == m and (a == b).all():
        return 0
    a, b = a.tolist(), b.tolist()
    big = most + 1
    row = [j if j <= most else big for j in range(m + 1)]
    for i in range(1, n + 1):
        lo, hi = max(1, i - most), min(m, i + most)
        new = [big] * (m + 1)
        if i <= most:
            new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j - 1] + (a[i - 1] != b[j - 1]), row[j] + 1, new[j - 1] + 1, big)
        row = new
        if min(row[lo - 1:hi + 1]) >= big:
            return big
    return row[m]


def aligned(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """The least word edit distance of the item to any run of ``words``, and such a run."""
    n, m = len(item), len(words)
    steps = np.arange(m + 1)
    row, begin = np.zeros(m + 1, dtype=np.int64), steps.copy()
    for i, word in enumerate(item, 1):
        best = np.append(row[0] + 1, np.minimum(row[:-1] + (words != word), row[1:] + 1))
        from_ = np.append(0, np.where(row[:-1] + (words != word) <= row[1:] + 1, begin[:-1], begin[1:]))
        low = np.minimum.accumulate(best - steps)
        at = np.maximum.accumulate(np.where(best - steps == low, steps, 0))  # where the run of insertions began
        row, begin = low + steps, from_[at]
    end = int(row.argmin())
    return int(row[end]), int(begin[end]), end


def distance(a: np.ndarray, b: np.ndarray) -> int:
    """Word edit distance."""
    steps = np.arange(len(b) + 1)
    row = steps
    for i, word in enumerate(a, 1):
        best = np.append(i, np.minimum(row[:-1] + (b != word), row[1:] + 1))
        row = np.minimum.accumulate(best - steps) + steps
    return int(row[-1])


def whole_windows(item: np.ndarray, words: np.ndarray, first: int) -> Iterator[tuple[int, int]]:
    """(distance, first word) of the near windows of a long item that begins about ``first`` in a document's words."""
    n = len(item)
    most = n // EDIT_SHARE
    lo = max(0, first - most)
    least, begin, end = aligned(item, words[lo:first + n + 2 * most])
    if least > most:
        return
    starts = sorted({min(max(0, s), len(words) - n) for s in range(min(lo + begin, lo + end - n), max(lo + begin, lo + end - n) + 1)})
    for s in starts:
        d = distance(item, words[s:s + n])
        if d <= most:
            yield d, s


def hopeful_windows(words: np.ndarray, offsets: np.ndarray, index: Index) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each item length, the windows that may be near an item: document numbers, first words, and the words."""
    if not index.items or not len(words):
        return
    # known pairs that begin before each word, all and fresh ones: those of a window are at most
    # all in its first RECENT words and the fresh ones in the rest
    every, fresh = (np.concatenate(([0], np.cumsum(x, dtype=np.int32))) for x in index.known(words))
    longest, size = index.lengths[-1], len(words)

    def most_pairs(starts: np.ndarray, n: int) -> np.ndarray:
        head = np.minimum(starts + min(RECENT, n - 1), size)
        return every[head] - every[starts] + fresh[np.minimum(starts + n - 1, size)] - fresh[head]

    hopeful = np.flatnonzero(most_pairs(np.arange(size), max(longest, RECENT + 1)) >= min(index.least.values()))
    limit = offsets[np.searchsorted(offsets, hopeful, side="right")]  # the end of its document
    for n in index.lengths:
        most = n // EDIT_SHARE
        starts = hopeful[hopeful + n <= limit]
        starts = starts[most_pairs(starts, n) >= index.least[n]]
        step = max(1, WAITING // (16 * n))
        for i in range(0, len(starts), step):
            part = starts[i:i + step]
            docs = np.searchsorted(offsets, part, side="right") - 1
            yield docs, part - offsets[docs], words[part[:, None] + np.arange(n)]


def near_windows(windows: np.ndarray, index: Index) -> Iterator[tuple[int, int, int]]:
    """(window, item or piece, distance) of the near ones among windows of one length."""
    n = windows.shape[1]
    most = n // EDIT_SHARE
    for lo in range(0, len(windows), 4_000):
        part = windows[lo:lo + 4_000]
        keys = window_keys(part)
        rows, columns = np.nonzero(index.key_bits[keys >> _U(42)])
        left, right = (np.searchsorted(index.keys, keys[rows, columns], side=side).tolist() for side in ("left", "right"))
        seen = set()
        for r, start, end in zip(rows.tolist(), left, right, strict=True):
            for k in index.owners[start:end].tolist():
                if (r, k) in seen or len(index.items[k][1]) != n:
                    continue
                seen.add((r, k))
                d = edit_distance(part[r], index.items[k][1], most)
                if d <= most:
                    yield lo + r, k, d


def find_in(strings, index: Index) -> Iterator[tuple[int, int, int, int]]:
    """(row, item number, distance, first word) of every near window that the keys reach, in an Arrow string array."""
    return found_in(textvec.chunks(strings, textvec.PUNCTUATION, True), index)


def found_in(chunks: Iterator[tuple[int, np.ndarray, np.ndarray]], index: Index) -> Iterator[tuple[int, int, int, int]]:
    """``find_in`` of chunks (first row, words, offsets)."""
    waiting: dict[int, list[tuple]] = {}
    size = 0

    def reached() -> Iterator[tuple[int, int, int, int]]:
        places: dict[tuple[int, int], set[int]] = {}  # of a document and a long item
        texts: dict[int, np.ndarray] = {}
        for parts in waiting.values():
            docs, firsts, windows, own = (np.concatenate([p[i] for p in parts]) if i < 3 else [p[3] for p in parts for _ in p[0]] for i in range(4))
            for r, k, d in near_windows(windows, index):
                doc, first, item = int(docs[r]), int(firsts[r]), index.of[k]
                if len(index.whole[item][1]) < LONG:
                    yield doc, item, d, first
                else:
                    places.setdefault((doc, item), set()).add(first - index.offset[k])
                    texts[doc] = own[r](doc)
        for (doc, item), firsts in places.items():
            words, found, last = index.whole[item][1], {}, -len(texts[doc])
            for first in sorted(firsts):
                if first - last > len(words) // EDIT_SHARE and len(texts[doc]) >= len(words):  # else the same place
                    found |= {s: d for d, s in whole_windows(words, texts[doc], max(0, min(first, len(texts[doc]) - len(words))))}
                    last = first
            yield from ((doc, item, d, s) for s, d in found.items())

    for row, words, offsets in chunks:
        def text(doc: int, row=row, words=words, offsets=offsets) -> np.ndarray:
            return words[offsets[doc - row]:offsets[doc - row + 1]]

        for docs, firsts, windows in hopeful_windows(words, offsets, index):
            waiting.setdefault(windows.shape[1], []).append((docs + row, firsts, windows, text))
            size += windows.nbytes
            if size >= WAITING:
                yield from reached()
                waiting, size = {}, 0
    yield from reached()


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list[tuple[int, str]], bool]]:
    """The benchmark in blocks of bounded size, one after the other, and whether there are several."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(size // (4 * BLOCK_WORDS)) + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for b in range(n):
        yield [(r[0], r[1]) for r in items.where(part == b).orderBy("item_id", "text").collect()], n > 1


_INDEXES: dict[int, Index] = {}


def _index(items: list[tuple[int, str]]) -> Index:
    if (key := hash(tuple(items))) not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = Index(items)
    return _INDEXES[key]


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, distance (the least), word_start (of its first window), n_windows."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = None
    for items, more in _blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(items)  # at most a block

        def run(batches: Iterator, shared=shared) -> Iterator:
            import pyarrow as pa

            index = _index(shared.value)
            for batch in batches:
                ids, found = batch.column(0).to_pylist(), {}
                for row, k, d, start in find_in(batch.column(1), index):
                    d0, s0, n = found.get((row, k), (d, start, 0))
                    found[row, k] = (*min((d0, s0), (d, start)), n + 1)
                columns = [[ids[i] for i, _ in found], [index.whole[k][0] for _, k in found],
                           *([v[c] for v in found.values()] for c in range(3))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 ["doc_id", "item_id", "distance", "word_start", "n_windows"])

        found = rows.mapInArrow(run, "doc_id long, item_id long, distance long, word_start long, n_windows long")
        if more:  # done with this block before the next one is fetched
            found = written(found, "decontamination-found")
            shared.destroy()
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """The documents that hold no near copy of an item, with their own columns."""
    spark = docs.sparkSession
    ship(spark)
    out = docs
    for items, more in _blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(items)  # at most a block

        def run(batches: Iterator, shared=shared) -> Iterator:
            import pyarrow as pa
            import pyarrow.compute as pc

            index = _index(shared.value)
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                texts = pc.fill_null(batch.column(batch.schema.names.index(text_col)), "")
                for row, *_ in find_in(texts, index):
                    keep[row] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
        if more:
            out = written(out, "decontamination-kept")
            shared.destroy()
    return out
