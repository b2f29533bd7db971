"""Exact top-k by inner product: the three-phase uniform threshold over lists of partial scores.

A score is the sum of BLOCKS partial scores, one for each block of components,
and every block is a list of its own: it sees only its components.

1. Gather: each block's list gives a query its k + 1 best partial scores. The
   exact scores of these few candidates are resolved; the (k + 1)-th best of them
   is a score that the result can't fall below.
2. Cutoff: a candidate that reaches this score has a partial score of at least a
   BLOCKS-th of it in some block. That cutoff goes to all lists, and they give
   every entry that reaches it: these are sufficient. A candidate whose known
   partial scores, with the best possible for the rest, stay below is dropped.
3. Resolve: the partial scores that are missing are computed for the candidates
   left, and the best of their exact scores are the result.

Equal vectors are one candidate (with their smallest ids) and one query, so
many copies of a vector make neither long lists of ties nor repeated searches;
k + 1 because a query's own row is taken out at the end. A list is worked on in
cells of SLAB queries by RANGE candidates, dealt by hash: a task holds one
cell, whatever the number of vectors.

Components x become floor(scale * x); scores are exact 64-bit integers, and a
score beyond them stops the job with an overflow error instead of a wrong result.

Defined cases: vectors that are null or hold a null or non-finite component take
no part, neither as queries nor as candidates; a shorter vector counts as filled
up with zeros (an empty one scores 0 with all); rows that repeat an id are
candidates of their own, and each row that is a query gets its own result; null
ids are no queries, and come last among equal scores; with fewer other rows than
k, all are given; other columns are ignored; no rows, no result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import ship, written

#: Blocks of components, each of which is a list of partial scores.
BLOCKS = 2
#: Queries and candidates in a cell of a list.
SLAB, RANGE = 4096, 16_384
#: Partial scores that a task has at hand at once.
SCORES_AT_ONCE = 4_000_000

ENTRY = "q long, c long, block int, partial long"


def _matrix(column) -> np.ndarray:
    """Rows of a list column, shorter ones filled up with zeros."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    values, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    lengths = np.diff(offsets)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - (offsets[:-1] - offsets[0])[row]] = values
    return out


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of ``a`` with all of ``b``; an overflow is an error."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = width * max(abs(int(a.min(initial=0))), int(a.max(initial=0))) * max(abs(int(b.min(initial=0))), int(b.max(initial=0)))
    if most < 2**53:  # every sum on the way is exact
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 2**63:
        return a @ b.T
    out = a.astype(object) @ b.T.astype(object)
    if any(abs(x) >= 2**63 for x in out.flat):
        raise OverflowError("a score does not fit into 64 bits")
    return out.astype(np.int64)


def _cell(best: int | None):
    """One cell of a list -> its entries: the ``best`` of each query, or all that reach the query's cutoff."""
    def run(cell):
        import pyarrow as pa

        asked = cell.column("cutoff").is_valid().to_numpy()
        queries, range_ = cell.filter(pa.array(asked)), cell.filter(pa.array(~asked))
        if not queries.num_rows or not range_.num_rows:
            return pa.table([[]] * 4, schema=pa.schema([("q", pa.int64()), ("c", pa.int64()), ("block", pa.int32()), ("partial", pa.int64())]))
        a, b = _matrix(queries.column("x")), _matrix(range_.column("x"))
        ids, others = queries.column("c").to_numpy(), range_.column("c").to_numpy()
        cutoffs = queries.column("cutoff").to_numpy()
        step, found = max(1, SCORES_AT_ONCE // len(b)), []
        for i in range(0, len(a), step):
            scores = inner_products(a[i:i + step], b)
            if best is None:
                row, at = np.nonzero(scores >= cutoffs[i:i + step, None])
            else:
                at = np.argpartition(scores, -min(best, len(b)), axis=1)[:, -best:] if best < len(b) else np.tile(np.arange(len(b)), (len(scores), 1))
                row, at = np.repeat(np.arange(len(scores)), at.shape[1]), at.ravel()
            found.append((ids[i:i + step][row], others[at], scores[row, at]))
        q, c, partial = map(np.concatenate, zip(*found, strict=True))
        block = np.full(len(q), cell.column("block")[0].as_py(), dtype=np.int32)
        return pa.table({"q": q, "c": c, "block": block, "partial": partial})
    return run


def _block(x: Column, block: Column) -> Column:
    return F.filter(x, lambda v, i: i % BLOCKS == block)


def _entries(classes: DataFrame, cutoffs: DataFrame, slabs: int, ranges: int, best: int | None) -> DataFrame:
    """The lists' entries for queries (q, cutoff): the ``best`` in each cell, or those that reach the cutoff."""
    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("c"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    queries = classes.join(cutoffs, F.col("c") == F.col("q")).select("c", "v", "cutoff", dealt(slabs).alias("slab"), every(ranges).alias("range"))
    others = classes.select("c", "v", F.lit(None).cast("long").alias("cutoff"), every(slabs).alias("slab"), dealt(ranges).alias("range"))
    lists = queries.unionByName(others).select("slab", "range", "c", "cutoff", "v", every(BLOCKS).alias("block"))
    parts = lists.select("slab", "range", "block", "c", "cutoff", _block(F.col("v"), F.col("block")).alias("x"))
    return parts.groupBy("slab", "range", "block").applyInArrow(_cell(best), ENTRY)


def _resolved(missing: DataFrame, classes: DataFrame) -> DataFrame:
    """q, c, block -> with the exact partial score."""
    there = classes.select("c", F.col("v").alias("_there"))
    here = classes.where("asked").select(F.col("c").alias("q"), F.col("v").alias("_here"))
    products = F.zip_with(_block(F.col("_here"), F.col("block")), _block(F.col("_there"), F.col("block")),
                          lambda a, b: F.coalesce(a * b, F.lit(0).cast("long")))
    return (missing.join(there, "c").join(here, "q")
            .select("q", "c", "block", F.aggregate(products, F.lit(0).cast("long"), lambda s, p: s + p).alias("partial")))


def _best(rows: DataFrame, n: int, keys: list[str], order: list[Column], rank: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(rank, place).where(F.col(rank) <= n)


def search(vectors: DataFrame, every: int, k: int, scale: int = 256, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """The ``k`` other rows of the highest inner product for every row whose id is divisible by ``every``.

    query_id, rank (from 1), vec_id, score; ties go to the smaller id.
    """
    spark = vectors.sparkSession
    ship(spark)
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.where(F.col(vector_col).isNotNull() & finite).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
    is_query = F.coalesce(F.col("id") % every == 0, F.lit(False))

    # Equal vectors together, with the few smallest ids that can matter.
    flags = rows.groupBy("v").agg(F.max(is_query).alias("asked"))
    least = _best(rows, k + 1, ["v"], [F.col("id").asc_nulls_last()], "nth").groupBy("v").agg(
        F.sort_array(F.collect_list(F.struct("nth", "id"))).alias("ids"))
    classes = written(flags.join(least, "v").select(F.monotonically_increasing_id().alias("c"), "v", "asked", F.col("ids.id").alias("ids")),
                      "topk-vectors")
    n, asked = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asked").cast("long")), F.lit(0))).first()
    slabs, ranges = -(-max(asked, 1) // SLAB), -(-max(n, 1) // RANGE)
    queries = classes.where("asked").select(F.col("c").alias("q"))

    # 1. Local lists; the exact scores of what they hold give a first bound.
    local = _entries(classes, queries.withColumn("cutoff", F.lit(0).cast("long")), slabs, ranges, k + 1)
    known = written(_best(local, k + 1, ["q", "block"], [F.desc("partial"), F.asc("c")], "nth"), "topk-lists")
    block = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block")
    first = _resolved(known.select("q", "c").distinct().select("q", "c", block), classes).groupBy("q", "c").agg(F.sum("partial").alias("score"))
    bounds = _best(first, k + 1, ["q"], [F.desc("score"), F.asc("c")], "nth").where(F.col("nth") == k + 1).select("q", F.col("score").alias("bound"))

    # 2. The uniform cutoff, and every entry that reaches it.
    lowest = F.lit(-(2**63)).cast("long")
    cutoff = F.coalesce(F.ceil(F.col("bound").cast("decimal(38,0)") / BLOCKS).cast("long"), lowest)
    cutoffs = written(queries.join(bounds, "q", "left").select("q", "bound", cutoff.alias("cutoff")), "topk-cutoffs")
    seen = written(_entries(classes, cutoffs.select("q", "cutoff"), slabs, ranges, None), "topk-entries")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    candidates = seen.groupBy("q", "c").agg(F.sum("partial").alias("seen"), F.collect_list("block").alias("blocks")).join(cutoffs, "q")
    possible = wide("seen") + (BLOCKS - F.size("blocks")) * (wide("cutoff") - 1)
    candidates = candidates.where(F.col("bound").isNull() | (possible >= wide("bound")))

    # 3. What is still missing.
    blocks = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    unseen = candidates.select("q", "c", F.explode(F.array_except(blocks, F.col("blocks"))).alias("block"))
    parts = candidates.select("q", "c", F.col("seen").alias("partial")).unionByName(_resolved(unseen, classes).select("q", "c", "partial"))
    scores = parts.groupBy("q", "c").agg(F.sum("partial").alias("score"))
    ids = classes.select("c", "ids")
    found = _best(scores.join(ids, "c"), k + 1, ["q"], [F.desc("score"), F.col("ids")[0].asc_nulls_last()], "nth")
    found = written(found.groupBy("q").agg(F.collect_list(F.struct("c", "score", "ids")).alias("found")), "topk-found")

    # Back to rows: a query's own row goes, the others are ranked.
    asking = rows.where(is_query).join(classes.where("asked").select("v", F.col("c").alias("q")), "v").groupBy("q", "id").agg(F.count(F.lit(1)).alias("copies"))
    near = asking.join(found, "q").select("q", "id", "copies", F.explode("found").alias("f"))
    own = F.when(F.col("f.c") == F.col("q"), F.array_position("f.ids", F.col("id"))).otherwise(F.lit(0))
    others = near.withColumn("own", own).select("q", "id", "copies", F.col("f.score").alias("score"), F.explode(
        F.filter("f.ids", lambda x, i: i + 1 != F.col("own"))).alias("vec_id"))
    ranked = _best(others, k, ["q", "id"], [F.desc("score"), F.col("vec_id").asc_nulls_last()], "rank")
    return ranked.select(F.col("id").alias("query_id"), "rank", "vec_id", "score", F.explode(
        F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copy")


def oracle_sql(every: int, k: int, scale: int = 256) -> str:
    return f"""
WITH good AS (
  SELECT vec_id, [floor({scale} * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id % {every} = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}"""
