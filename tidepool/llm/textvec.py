"""Words of many texts as 64-bit hashes, by array operations on their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
#: Texts are worked on in chunks of about this many bytes, so that arrays stay in the caches.
CHUNK = 1 << 20

#: White space as in ``common.WORD``: every other byte belongs to a word.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True

#: ASCII letters (read as lower case) and digits, and all bytes beyond ASCII, make words.
PUNCTUATION = np.ones(256, dtype=bool)
PUNCTUATION[np.r_[48:58, 65:91, 97:123, 128:256]] = False
_LOWER = np.arange(256)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of an odd number modulo 2^64, as far as they were needed."""

    def __init__(self, base: int):
        self.base, self.table = _U(base), np.ones(1, dtype=_U)

    def upto(self, n: int) -> np.ndarray:
        while len(self.table) < n:
            step = self.table[-1] * self.base
            self.table = np.concatenate((self.table, self.table * step))
        return self.table[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)


def word_hashes(data: np.ndarray, starts: np.ndarray, separators: np.ndarray,
                fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after the other in ``data``.

    ``starts``: n + 1 byte offsets of the n texts. Returns the hashes of all
    words in order and n + 1 offsets into them. A word never crosses two texts.
    """
    n = len(data)
    if not n:
        return np.zeros(0, dtype=_U), np.zeros(len(starts), dtype=np.int64)
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= separators[data[:-1]]
    edges = starts[1:-1]
    edges = edges[edges < n]
    begins[edges] = inside[edges]
    ends = inside.copy()  # of the last byte
    ends[:-1] &= separators[data[1:]]
    before = edges[edges > 0] - 1
    ends[before] = inside[before]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    table = _BYTES[_LOWER] if fold else _BYTES
    sums = np.zeros(n + 1, dtype=_U)
    with np.errstate(over="ignore"):
        np.cumsum(table[data] * _UP.upto(n), out=sums[1:])
        hashes = mix((sums[last + 1] - sums[first]) * _DOWN.upto(n)[first])
    return hashes, np.searchsorted(first, starts)


def chunks(strings, separators: np.ndarray, fold: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, word offsets) for runs of rows of an Arrow string array without nulls."""
    import pyarrow as pa

    strings = strings.cast(pa.large_string())
    if not len(strings):
        return
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset:strings.offset + len(strings) + 1]
    buffer = strings.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(strings):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        part = offsets[row:end + 1]
        yield row, *word_hashes(data[part[0]:part[-1]], part - part[0], separators, fold)
        row = end


def hashes_of(text: str, separators: np.ndarray, fold: bool = False) -> np.ndarray:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return word_hashes(data, np.array([0, len(data)]), separators, fold)[0]


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words; of a shorter text, one of all its words; of none, none."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    out = np.zeros(n - k + 1, dtype=_U)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = out * _U(0x9DDFEA08EB382D69) + words[i:n - k + 1 + i]
        return mix(out + _U(k))
