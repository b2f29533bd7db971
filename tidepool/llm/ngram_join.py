"""Near-duplicate join on 5-word shingles: LSH, Bayesian pruning of candidates, exact verification.

A document is the set of its 5-word runs (of a shorter one, the run of all its
words); two are linked if the Jaccard similarity of their sets is 0.8 or more.

1. One pass over the texts: set hash (128 bits) and MinHash bands. Documents of
   one set are a class; only its representative (least id) goes on.
2. Representatives that share a band are tied to the band's least one (a star,
   not all pairs), and the stars' connected components are the neighbourhoods
   in which links can lie.
3. Within a neighbourhood all representatives are compared, in blocks of BLOCK
   documents against blocks, so a large one is many tasks of bounded size. A
   pair's MinHash values are compared STEP by STEP; as soon as the posterior
   probability (uniform prior) that its similarity reaches the threshold falls
   below TOLERANCE, the pair is dropped. All other pairs are verified exactly
   on their sets. A task gives back one row for each document: how many others
   it is linked with, and a spanning forest of the links, never the pairs.
4. Connected components of these forests are the groups.

Loss: two sets at similarity 0.8 share none of 40 bands of 6 values with a
probability of 5e-6 (and still meet if others tie them), and Bayesian pruning
loses at most TOLERANCE in each of 8 steps.

Defined cases: null and empty texts and null ids have no links and are a class
of their own; repeated ids are taken for versions of one document; extra
columns are ignored by ``linked_documents`` and kept by ``one_of_each_group``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import textvec
from tidepool.llm.common import id_text, ship, written
from tidepool.llm.components import components

_U = np.uint64
WORDS, THRESHOLD = 5, 0.8
BANDS, BAND_ROWS = 40, 6
#: MinHash values compared between two looks at the posterior, and the least posterior to go on.
STEP, TOLERANCE = 30, 1e-6
#: Documents in a block; a task compares two blocks at most.
BLOCK = 256

_RNG = np.random.default_rng(20240501)
_FACTORS = _RNG.integers(0, 1 << 32, BANDS * BAND_ROWS, dtype=np.uint32) | np.uint32(1)
_TERMS = _RNG.integers(0, 1 << 32, BANDS * BAND_ROWS, dtype=np.uint32)


def minhashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(texts, BANDS * BAND_ROWS) MinHash values of runs of shingle hashes, none of them empty."""
    short = (values >> _U(32)).astype(np.uint32)
    out = np.empty((len(starts), len(_FACTORS)), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for i in range(len(_FACTORS)):
            out[:, i] = np.minimum.reduceat(short * _FACTORS[i] + _TERMS[i], starts)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """(texts, BANDS) keys; equal keys of different bands do not meet."""
    parts = signature.reshape(len(signature), BANDS, BAND_ROWS).astype(_U)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U), (len(signature), BANDS)).copy()
    with np.errstate(over="ignore"):
        for i in range(BAND_ROWS):
            key = textvec.mix(key * _U(0x9DDFEA08EB382D69) + parts[:, :, i])
    return key.view(np.int64)


def _sets(strings) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted different shingle hashes) of each row of an Arrow string array that has words."""
    for first, words, offsets in textvec.chunks(strings, textvec.SPACES):
        for i in range(len(offsets) - 1):
            own = words[offsets[i]:offsets[i + 1]]
            if len(own):
                yield first + i, np.unique(textvec.shingles(own, WORDS))


def _runs(sets: Iterator[tuple[int, np.ndarray]], most: int = 200_000) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    rows, own, size = [], [], 0
    for row, values in sets:
        rows.append(row)
        own.append(values)
        size += len(values)
        if size >= most:
            yield rows, own
            rows, own, size = [], [], 0
    if rows:
        yield rows, own


def _starts(sets: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1])).astype(np.int64)


def _sketch(batches: Iterator) -> Iterator:
    """doc_id, text -> doc_id, two halves of the set's hash (null without words), bands."""
    import pyarrow as pa

    for batch in batches:
        n = batch.num_rows
        hi, lo, keys = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), [None] * n
        has = np.zeros(n, dtype=bool)
        for rows, sets in _runs(_sets(batch.column(1))):
            flat, starts = np.concatenate(sets), _starts(sets)
            has[rows] = True
            with np.errstate(over="ignore"):
                hi[rows] = np.add.reduceat(textvec.mix(flat + _U(1)), starts).view(np.int64)
                lo[rows] = np.add.reduceat(textvec.mix(flat ^ _U(0xA5A5A5A5A5A5A5A5)), starts).view(np.int64)
            for row, key in zip(rows, bands(minhashes(flat, starts)).tolist(), strict=True):
                keys[row] = key
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(hi, pa.int64(), mask=~has), pa.array(lo, pa.int64(), mask=~has),
             pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "hi", "lo", "bands"])


def _represent(batches: Iterator) -> Iterator:
    """node, text, ... -> the same with the set and its MinHash values (bytes) for the text."""
    import pyarrow as pa

    for batch in batches:
        n = batch.num_rows
        shingles, signatures = [b""] * n, [b""] * n
        for rows, sets in _runs(_sets(batch.column(batch.schema.names.index("text")))):
            for row, own, signature in zip(rows, sets, minhashes(np.concatenate(sets), _starts(sets)), strict=True):
                shingles[row], signatures[row] = own.tobytes(), signature.tobytes()
        keep = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), pa.array(shingles, pa.binary()), pa.array(signatures, pa.binary())],
            [*keep, "shingles", "signature"])


@cache
def least_matches(n: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Fewest equal ones of n MinHash values with which a pair goes on.

    With a uniform prior, m equal ones of n leave P(similarity > t) =
    P(Binomial(n + 1, t) <= m).
    """
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n


def pruned(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i of left, j of right) that Bayesian pruning leaves."""
    equal = np.zeros(len(i), dtype=np.int32)
    for start in range(0, left.shape[1], STEP):
        end = min(start + STEP, left.shape[1])
        equal += (left[i, start:end] == right[j, start:end]).sum(axis=1, dtype=np.int32)
        go = equal >= least_matches(end)
        i, j, equal = i[go], j[go], equal[go]
    return i, j


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs' sets."""
    if len(i) < 1_000:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)],
                        dtype=np.int64)
    # many pairs among few sets: a product of their incidence matrices, some columns at a time
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, columns, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    inside = shared[columns]
    owners, columns = owners[inside], number[columns[inside]]
    order = np.argsort(columns, kind="stable")
    owners, columns = owners[order], columns[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 2_048
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(columns, [lo, lo + width])
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[owners[a:b], columns[a:b] - lo] = 1
        total += part @ part.T
    return total[i, j].astype(np.int64)


def _pairs(count: int, blocks: np.ndarray, first: int, second: int, most: int = 50_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a block, or of one with another, in portions."""
    if first == second:
        rows = [(i, np.arange(i + 1, count)) for i in range(count)]
    else:
        others = np.flatnonzero(blocks == second)
        rows = [(i, others) for i in np.flatnonzero(blocks == first).tolist()]
    i, j, size = [], [], 0
    for a, bs in rows:
        i.append(np.full(len(bs), a))
        j.append(bs)
        size += len(bs)
        if size >= most:
            yield np.concatenate(i), np.concatenate(j)
            i, j, size = [], [], 0
    if size:
        yield np.concatenate(i), np.concatenate(j)


def _compare(table):
    """One neighbourhood's block with another: node, linked documents, and a node it is tied to."""
    import pyarrow as pa

    nodes, sizes = table.column("node").to_numpy(), table.column("size").to_numpy()
    blocks = table.column("block").to_numpy()
    first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py()
    sets = [np.frombuffer(x, dtype=_U) for x in table.column("shingles").to_pylist()]
    signatures = np.stack([np.frombuffer(x, dtype=np.uint32) for x in table.column("signature").to_pylist()])
    lengths = np.array([len(s) for s in sets])
    left, right = [], []
    for i, j in _pairs(len(nodes), blocks, first, second):
        small, large = np.minimum(lengths[i], lengths[j]), np.maximum(lengths[i], lengths[j])
        fits = (small >= THRESHOLD * large) & (nodes[i] != nodes[j])  # else the sizes alone rule it out
        i, j = pruned(signatures, signatures, i[fits], j[fits])
        left.append(i)
        right.append(j)
    i, j = (np.concatenate(x or [np.zeros(0, dtype=np.int64)]).astype(np.int64) for x in (left, right))
    common = _common(sets, i, j)
    linked = common >= THRESHOLD * (lengths[i] + lengths[j] - common) - 1e-9
    i, j = i[linked], j[linked]
    links = np.bincount(i, weights=sizes[j], minlength=len(nodes)) + np.bincount(j, weights=sizes[i], minlength=len(nodes))
    # a spanning forest: labels sink to the least node until none changes
    label, rank = np.arange(len(nodes)), np.argsort(np.argsort(nodes, kind="stable"), kind="stable")
    label = rank.copy()
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == label).all():
            break
        label = new
    ordered = np.sort(nodes, kind="stable")
    has = links > 0
    return pa.table({"node": nodes[has], "links": links[has].astype(np.int64), "tied": ordered[label[has]]})


def _classes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The sketches (doc_id, hi, lo), and all classes that are more than one unlinked document:
    hi, lo, class_id, size, links, group_id."""
    ship(docs.sparkSession)
    texts = id_text(docs, id_col, text_col)
    sketches = written(texts.mapInArrow(_sketch, "doc_id long, hi long, lo long, bands array<long>"), "ngram-sketches")
    known = sketches.where("doc_id IS NOT NULL AND hi IS NOT NULL")
    classes = written(known.groupBy("hi", "lo").agg(F.min("doc_id").alias("node"), F.count("*").alias("size")), "ngram-classes")
    first = known.join(classes.withColumnRenamed("node", "doc_id"), ["hi", "lo", "doc_id"], "left_semi")
    keys = first.select(F.col("doc_id").alias("node"), F.explode("bands").alias("key"))
    stars = written(keys.groupBy("key").agg(F.min("node").alias("root"), F.max("node").alias("last"))
                    .where("root < last").drop("last"), "ngram-stars")
    near = components(keys.join(stars, "key").select(F.col("node").alias("a"), F.col("root").alias("b")))
    near = written(near, "ngram-near")
    sizes = near.groupBy("root").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = near.join(sizes, "root").select("node", "root", blocks.alias("blocks"),
                                             F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))
    placed = placed.join(classes.select("node", "size", "hi", "lo"), "node")
    members = written(texts.join(placed, texts.doc_id == placed.node)
                      .select("node", "root", "block", "blocks", "size", "text")
                      .mapInArrow(_represent, "node long, root long, block int, blocks int, size long, shingles binary, signature binary"),
                      "ngram-members")
    pairs = members.where("length(signature) > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "root", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
        "node", "block", "size", "shingles", "signature")
    compared = written(pairs.groupBy("root", "first", "second").applyInArrow(_compare, "node long, links long, tied long"),
                       "ngram-links")
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(compared.select(F.col("node").alias("a"), F.col("tied").alias("b")))
    joined = links.join(groups, "node", "left").withColumnRenamed("root", "group")
    out = (classes.join(joined, "node", "left").where("size > 1 OR links IS NOT NULL")
           .select("hi", "lo", F.col("node").alias("class_id"), "size", F.coalesce("links", F.lit(0)).alias("links"),
                   F.coalesce("group", "node").alias("group_id")))
    return sketches.select("doc_id", "hi", "lo"), written(out, "ngram-groups")


def linked_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (least id of its class), n_links (other documents at 0.8 or more), group_id, for each row."""
    rows, classes = _classes(docs, id_col, text_col)
    return rows.join(classes, ["hi", "lo"], "left").select(
        "doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce(F.col("size") - 1 + F.col("links"), F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("group_id", "doc_id")).alias("group_id"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the least id of each group, and all that are in none, with their own columns.

    Of rows that repeat such an id, one stays; rows with a null id all stay.
    """
    rows, classes = _classes(docs, id_col, text_col)
    seen = (rows.where("doc_id IS NOT NULL").join(classes.select("hi", "lo", "group_id"), ["hi", "lo"], "left")
            .groupBy("doc_id").agg(F.count("*").alias("n"),
                                   F.max(F.coalesce("group_id", "doc_id") == F.col("doc_id")).alias("first")))
    seen = written(seen.where("n > 1 OR NOT first"), "ngram-seen")  # nothing to do for the others
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(f"`{id_col}`").cast("long").alias("_id"))
    out = rows.join(seen.select(F.col("doc_id").alias("_seen")), F.col("_id") == F.col("_seen"), "left_anti")
    again = rows.join(seen.where("first").select(F.col("doc_id").alias("_seen")), F.col("_id") == F.col("_seen"), "left_semi")
    return out.union(again.dropDuplicates(["_id"])).select("_doc.*")


#: All pairs that share a shingle, counted; components by recursion.
ORACLE_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS rn, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + {WORDS - 1}], chr(0)) AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - {WORDS - 2}))) AS i FROM d
        WHERE doc_id IS NOT NULL AND len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
p AS MATERIALIZED (
  SELECT a, b, c = x.n AND c = y.n AS same FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE c >= {THRESHOLD} * (x.n + y.n - c) - 1e-9),
r AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON p.a = r.b),
g AS (SELECT a, least(a, min(b)) AS group_id FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n_links, least(a, min(b) FILTER (WHERE same)) AS class_id FROM p GROUP BY a)
SELECT doc_id, CASE WHEN doc_id IS NOT NULL THEN coalesce(class_id, doc_id) END AS class_id,
  coalesce(n_links, 0)::BIGINT AS n_links, CASE WHEN doc_id IS NOT NULL THEN coalesce(group_id, doc_id) END AS group_id
FROM d LEFT JOIN k ON k.a = doc_id LEFT JOIN g ON g.a = doc_id
"""
