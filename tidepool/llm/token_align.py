"""Alignment of two tokenizers' tokens: links by byte ranges, counted by external spill counting.

Every text is encoded by a byte-level BPE (A, with a space before the text) and a
sentence-piece model (B, which adds that space itself). Both cut the same bytes,
so a token of A and one of B are linked if their byte ranges overlap. How often a
pair of ids is linked in the whole corpus, and which A ids are the most frequent
partners of a B id, is counted in records (pair, document, number):

1. A task encodes texts until their links fill a run, sorts the run's records by
   pair, B's id first, and radix-partitions them by B's id. Each part is written
   as two zstd blocks: the run's pairs with their sums, and the documents of each.
2. Counting: the blocks of a part are dealt into groups of about FAN_IN runs; a
   k-way heap merge of their pairs counts each pair of a group. Groups of a part
   are added up, and in the order of B's ids the highest count of each is known.
3. Back: the groups meet their part's counts again and stream each run's
   documents past them, which gives every document its share.

A pair that is in all texts is one entry for each run, and its records are split
over the groups, so no task holds more than FAN_IN blocks of bounded runs.

Defined cases: texts that are null or empty, or whose tokens of A or B don't give
back the space and the text byte by byte, have no tokens: zeros and an empty
``groups_sha256``. Repeated rows and null ids count and give a row each. Texts are
encoded whole. Other columns are ignored; no rows, no result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import blocks, id_text, ship, written

#: Parts of the pairs, by B's id.
PARTS = 32
#: Links of a run, and runs that one group merges.
RUN_LINKS, FAN_IN = 1_500_000, 128
#: Characters of text that are encoded at once.
BLOCK_CHARS = 500_000
#: Characters beyond Latin letters and general punctuation.
UNSETTLED = re.compile("[^\u0000-\u024f\u2000-\u206f\u20ac]")
#: Bits of an id, and of a document's number in its run.
ID_BITS, NO_BITS = 20, 23
#: Entries of a run that the merge has at hand.
STEP = 4096

TABLE = ("run long, no int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
         "part int, pairs binary, docs binary")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(a_json), sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.a.encode_special_tokens = True
        byte_of, vocabulary = _byte_of(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token) else token.encode()
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << ID_BITS:
            raise ValueError("vocabularies have at most 2^20 entries")
        self.quick = self._quick(json.loads(a_json))
        self.length_a, self.length_b = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.bytes_a, self.bytes_b))
        self.told = [f"{i}{end}".encode() for n, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for i in range(n) for end in ends]

    def _quick(self, parts: dict):
        """A coder of the same merges by rank; None if A is no plain byte-level BPE whose ids are in the order of its merges."""
        import public_tokenizers
        import tiktoken

        model, before = parts["model"], parts.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges") or []]
        plain = (model.get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                 and not before.get("add_prefix_space") and not parts.get("normalizer") and not model.get("dropout")
                 and not model.get("ignore_merges"))
        added = {t["content"] for t in parts["added_tokens"]}
        if not plain or any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        ranks = {self.bytes_a[i]: i for token, i in model["vocab"].items() if token not in added}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encoded_a(self, texts: list[str]) -> list[list[int]]:
        """A's ids. Texts of long-settled characters, on whose classes all versions of Unicode agree, go through the quicker coder."""
        slow = [i for i, t in enumerate(texts) if self.quick is None or UNSETTLED.search(t)]
        found = dict(zip(slow, self.a.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False), strict=True)) if slow else {}
        return [found[i].ids if i in found else self.quick.encode_ordinary(t) for i, t in enumerate(texts)]

    def encoded(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Both lists of ids of each text; None if they don't give back its bytes."""
        spaced = [" " + t for t in texts]
        out: list = []
        for text, a, b in zip(spaced, self.encoded_a(spaced), self.b.encode(texts, num_threads=1), strict=True):
            whole = text.encode()
            same = whole == b"".join(map(self.bytes_a.__getitem__, a)) == b"".join(map(self.bytes_b.__getitem__, b))
            out.append((a, b) if same and len(whole) > 1 else None)
        return out


class Links:
    """The links of some texts, whose tokens lie one after the other."""

    def __init__(self, pair: Pair, coded: list[tuple[list[int], list[int]]]):
        self.pair = pair
        self.n_a, self.n_b = (np.array([len(x[i]) for x in coded], dtype=np.int64) for i in (0, 1))
        self.a, self.b = (np.concatenate([np.array(x[i], dtype=np.int64) for x in coded]) for i in (0, 1))
        self.end_a, self.end_b = np.cumsum(pair.length_a[self.a]), np.cumsum(pair.length_b[self.b])
        ends = np.concatenate((self.end_a, self.end_b))
        ends.sort(kind="stable")  # two runs
        ends = ends[np.r_[True, ends[1:] != ends[:-1]]]  # each stretch between two ends is one link
        at_a, at_b = np.searchsorted(self.end_a, ends), np.searchsorted(self.end_b, ends)
        common = (self.end_a[at_a] == ends) & (self.end_b[at_b] == ends)
        self.link_a, self.link_b = self.a[at_a], self.b[at_b]
        self.cuts = ends[common]
        last = np.searchsorted(ends, self.end_a[np.cumsum(self.n_a) - 1]) + 1  # each text's last end is common to both
        self.n_links = np.diff(last, prepend=0)
        self.n_groups = np.diff(np.cumsum(common)[last - 1], prepend=0)

    def records(self, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Different (pair, text) keys and their numbers of links; texts are numbered from ``first``."""
        no = np.repeat(np.arange(first, first + len(self.n_links)), self.n_links)
        return np.unique((self.link_b << (ID_BITS + NO_BITS)) | (self.link_a << NO_BITS) | no, return_counts=True)

    def groups(self) -> Iterator[bytes]:
        """Of each text its groups, as ``a1,a2|b1;a3|b2,b3``."""
        group_a, group_b = np.searchsorted(self.cuts, self.end_a), np.searchsorted(self.cuts, self.end_b)
        upto_a, upto_b = (np.cumsum(np.bincount(g, minlength=len(self.cuts))) for g in (group_a, group_b))
        before_b = upto_b - np.bincount(group_b, minlength=len(self.cuts))
        told = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        told[np.arange(len(self.a)) + before_b[group_a]] = 2 * self.a + (self.cuts[group_a] == self.end_a)
        told[np.arange(len(self.b)) + upto_a[group_b]] = 2 * (len(self.pair.bytes_a) + self.b) + (self.cuts[group_b] == self.end_b)
        at = 0
        for n in (self.n_a + self.n_b).tolist():
            yield b"".join(map(self.pair.told.__getitem__, told[at:at + n].tolist()))[:-1]
            at += n


class Run:
    """Records that become one run, and the numbers of their documents."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.links = self.size = 0

    def add(self, links: Links | None, rows: int) -> None:
        if links is not None:
            keys, counts = links.records(self.size)
            self.keys.append(keys)
            self.counts.append(counts)
            self.links += int(links.n_links.sum())
        self.size += rows

    def parts(self) -> Iterator[tuple[int, bytes, bytes]]:
        """part, (pairs, documents of each, sum of each), (document numbers, links); sorted by pair."""
        import zstandard

        if not self.keys:
            return
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        part = _part(keys >> (ID_BITS + NO_BITS))
        order = np.lexsort((keys, part))
        keys, counts, part = keys[order], counts[order], part[order]
        edges = np.searchsorted(part, np.arange(PARTS + 1))
        for p, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if i == j:
                continue
            pair = keys[i:j] >> NO_BITS
            starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
            documents = np.diff(np.append(starts, j - i))
            sums = np.add.reduceat(counts[i:j], starts)
            no = (keys[i:j] & ((1 << NO_BITS) - 1)).astype(np.int32)
            yield p, *(zstandard.compress(b"".join(x.astype(t).tobytes() for x, t in block), 1) for block in (
                ((pair[starts], np.int64), (documents, np.int32), (sums, np.int64)), ((no, np.int32), (counts[i:j], np.int32))))


def _part(b):
    """Part of a B id; neighbouring ids, often of like frequency, are spread."""
    return ((b * 0x9E3779B1) >> 12) % PARTS


def _pairs(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.decompress(block)
    n = len(raw) // 20
    return np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.int32, n, 8 * n), np.frombuffer(raw[12 * n:], np.int64)


_LOADED: dict[int, Pair] = {}


def _loaded(a_json: str, b_model: bytes) -> Pair:
    key = hash((a_json, b_model))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Pair(a_json, b_model)
    return _LOADED[key]


def _encode(files, with_groups: bool):
    """doc_id, text -> TABLE: a row for each document, and the blocks of each run."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        pair = _loaded(*files.value)
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, TABLE.split(", "))])
        name, now = TaskContext.get().partitionId() << 32, Run()

        def rows(found: list[dict]):
            return pa.RecordBatch.from_pylist(found, schema)

        def finished():
            return rows([{"run": name, "part": part, "pairs": pairs, "docs": docs} for part, pairs, docs in now.parts()])

        for batch in batches:
            for ids, texts in blocks(batch, BLOCK_CHARS):
                coded = pair.encoded(texts)
                with_tokens = [i for i, x in enumerate(coded) if x is not None]
                order = [*with_tokens, *(i for i, x in enumerate(coded) if x is None)]
                links = Links(pair, [coded[i] for i in with_tokens]) if with_tokens else None
                found = [{"run": name, "no": now.size + n, "doc_id": ids[i], "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "",
                          "groups": "" if with_groups else None} for n, i in enumerate(order)]
                if links is not None:
                    for row, n_a, n_b, n_groups, n_links, groups in zip(found, *(x.tolist() for x in (links.n_a, links.n_b, links.n_groups, links.n_links)),
                                                                        links.groups(), strict=False):
                        row |= {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": hashlib.sha256(groups).hexdigest()}
                        if with_groups:
                            row["groups"] = groups.decode()
                now.add(links, len(order))
                yield rows(found)
                if now.links >= RUN_LINKS or now.size >= 1 << (NO_BITS - 1):
                    yield finished()
                    name, now = name + 1, Run()
        yield finished()
    return run


def _merge(group):
    """The runs of a group -> their pairs with the group's counts, by a k-way heap merge."""
    import pyarrow as pa

    def entries(block: bytes) -> Iterator[tuple[int, int]]:
        pairs, _, sums = _pairs(block)
        for i in range(0, len(pairs), STEP):
            yield from zip(pairs[i:i + STEP].tolist(), sums[i:i + STEP].tolist(), strict=True)

    found, totals, now, total = [], [], None, 0
    for pair, n in heapq.merge(*map(entries, group.column("pairs").to_pylist()), key=itemgetter(0)):
        if pair != now:
            if now is not None:
                found.append(now)
                totals.append(total)
            now, total = pair, 0
        total += n
    found.append(now)
    totals.append(total)
    part = group.column("part")[0].as_py()
    return pa.table({"part": pa.array([part] * len(found), pa.int32()), "pair": pa.array(found, pa.int64()), "n": pa.array(totals, pa.int64())})


def _back(runs, counts):
    """The runs of a group and its part's counts -> run, no, links with the B id's best partner, sum of the counts."""
    import pyarrow as pa
    import zstandard

    order = np.argsort(counts.column("pair").to_numpy())
    known, count, best = (counts.column(c).to_numpy()[order] for c in ("pair", "n", "best"))
    out = []
    for run, pairs, docs in zip(*(runs.column(c).to_pylist() for c in ("run", "pairs", "docs")), strict=True):
        pair, documents, _ = _pairs(pairs)
        raw = zstandard.decompress(docs)
        no, links = np.frombuffer(raw, np.int32, len(raw) // 8), np.frombuffer(raw[len(raw) // 2:], np.int32).astype(np.int64)
        at = np.repeat(np.searchsorted(known, pair), documents)
        n_best, sums = np.zeros((2, int(no.max()) + 1), dtype=np.int64)
        np.add.at(n_best, no, links * best[at])
        np.add.at(sums, no, links * count[at])
        there = np.unique(no)
        out.append((np.full(len(there), run, dtype=np.int64), there, n_best[there], sums[there]))
    names = ["run", "no", "n_best", "count_sum"]
    if not out:
        return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())], names)
    return pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names)


def _counted(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, with_groups: bool) -> tuple[DataFrame, DataFrame, int]:
    """The written table, (part, pair, n, best), and the number of groups of a part."""
    spark = docs.sparkSession
    ship(spark)
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:  # fixed vocabularies, a few MB
        files = spark.sparkContext.broadcast((f.read(), g.read()))
    table = written(id_text(docs, id_col, text_col).mapInArrow(_encode(files, with_groups), TABLE), "align-runs")
    runs = table.where("part IS NOT NULL")
    groups = -(-runs.select("run").distinct().count() // FAN_IN) or 1
    merged = _dealt(runs, groups).select("part", "salt", "pairs").groupBy("part", "salt").applyInArrow(_merge, "part int, pair long, n long")
    counts = merged.groupBy("part", "pair").agg(F.sum("n").alias("n"))
    most = F.max("n").over(Window.partitionBy("part", F.shiftright("pair", ID_BITS)))
    return table, written(counts.select("part", "pair", "n", (F.col("n") == most).cast("long").alias("best")), "align-counts"), groups


def _dealt(runs: DataFrame, groups: int) -> DataFrame:
    return runs.withColumn("salt", F.pmod(F.xxhash64("run"), F.lit(groups)).cast("int"))


def pair_counts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """a_id, b_id, n: how many links of the corpus hold this pair; best: whether no other A id is linked with the B id more often."""
    _, counts, _ = _counted(docs, a_path, b_path, id_col, text_col, False)
    return counts.select(F.col("pair").bitwiseAND((1 << ID_BITS) - 1).alias("a_id"), F.shiftright("pair", ID_BITS).alias("b_id"), "n",
                         (F.col("best") == 1).alias("best"))


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                    with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every text; with ``groups`` on request.

    n_best: links whose pair is the most frequent one of its B id; count_sum: of the pairs' counts over all links.
    """
    table, counts, groups = _counted(docs, a_path, b_path, id_col, text_col, with_groups)
    runs = _dealt(table.where("part IS NOT NULL"), groups).select("part", "salt", "run", "pairs", "docs")
    every = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    shares = runs.groupBy("part", "salt").cogroup(every.groupBy("part", "salt")).applyInArrow(_back, "run long, no int, n_best long, count_sum long")
    sums = shares.groupBy("run", "no").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return table.where("part IS NULL").join(sums, ["run", "no"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", *(["groups"] if with_groups else []))
