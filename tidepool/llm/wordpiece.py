"""Token counts by a linear longest-match automaton.

A trie holds the vocabulary's bytes. Every node also holds where to go on when
the next byte has no edge (its failure link) and how many pieces that step
completes, both computed once, breadth first. Reading a word then takes one
pass over its bytes: greedy longest-match piece counts come out without any
piece being built or any byte being read twice.

A word is a run of characters other than ASCII white space. It is read with one
space before it, as the vocabulary marks pieces that begin a word by a space.
Where the vocabulary lacks a piece for some byte, the word counts as one
unknown piece, as in greedy word-piece coding.

Defined cases: null or empty texts have no words and no tokens; repeated rows
and null ids give a row each; other columns are ignored; no input rows, no rows.
"""

from __future__ import annotations

import base64
import re
from collections import Counter, deque
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from tidepool.llm.common import WORD, blocks, id_text, ship

#: Most words that a worker remembers the count of.
MEMO_WORDS = 1_000_000

#: A task takes texts of about this many characters at a time.
BLOCK_CHARS = 16_000_000

SCHEMA = "doc_id long, n_words long, n_tokens long"
_ROOT = 0


class PieceCounter:
    def __init__(self, vocabulary: Iterable[bytes]):
        edges: dict[int, int] = {}  # node * 256 + byte: node
        final, n = {_ROOT: False}, 1
        children: dict[int, list[tuple[int, int]]] = {}
        for piece in vocabulary:
            node = _ROOT
            for b in piece:
                to = edges.get(node << 8 | b)
                if to is None:
                    to = edges[node << 8 | b] = n
                    children.setdefault(node, []).append((b, n))
                    final[n] = False
                    n += 1
                node = to
            if node:
                final[node] = True
        fail, popped = [-1] * n, [0] * n
        queue = deque([_ROOT])
        while queue:
            u = queue.popleft()
            for b, v in children.get(u, ()):
                queue.append(v)
                if final[v]:
                    fail[v], popped[v] = _ROOT, 1
                    continue
                count, z = popped[u], fail[u]
                while z >= 0 and (z << 8 | b) not in edges:
                    count += popped[z]
                    z = fail[z]
                if z >= 0:
                    fail[v], popped[v] = edges[z << 8 | b], count
        self.edges, self.fail, self.popped = edges, fail, popped
        self.memo: dict[str, int] = {}

    def count(self, word: bytes) -> int:
        """Pieces of one word; an unknown word is one piece."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node, count = _ROOT, 0
        for b in word:
            to = edges.get(node << 8 | b)
            while to is None:
                count += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                to = edges.get(node << 8 | b)
            node = to
        while node > 0:
            count += popped[node]
            node = fail[node]
        return 1 if node < 0 else count

    def count_text(self, words: list[str]) -> int:
        memo, total = self.memo, 0
        for word, times in Counter(words).items():
            got = memo.get(word)
            if got is None:
                got = self.count(b" " + word.encode())
                if len(memo) < MEMO_WORDS and len(word) <= 64:
                    memo[word] = got
            total += got * times
        return total


def vocabulary_of(lines: bytes) -> list[bytes]:
    """The pieces of a rank file."""
    return [base64.b64decode(x.split()[0]) for x in lines.splitlines() if x]


_LOADED: dict[int, PieceCounter] = {}


def _loaded(lines: bytes) -> PieceCounter:
    if (key := hash(lines)) not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = PieceCounter(vocabulary_of(lines))
    return _LOADED[key]


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Words and word pieces of every whole text."""
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary_path, "rb") as f:
        lines = spark.sparkContext.broadcast(f.read())  # a fixed vocabulary, under 1 MB

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counter, words_of = _loaded(lines.value), re.compile(WORD).findall
        for batch in batches:
            for ids, texts in blocks(batch, BLOCK_CHARS):
                words = list(map(words_of, texts))
                columns = [ids, list(map(len, words)), list(map(counter.count_text, words))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 ["doc_id", "n_words", "n_tokens"])

    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
