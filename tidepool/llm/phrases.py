"""Phrases whose words keep company: SON partitioning, then exact counts and a cut score.

Frequent phrases of up to MAX_WORDS words are found by partitions (SON):

1. The rows are dealt into SHARDS shards, and the words of each shard are counted
   by language.
2. Each shard is mined completely at a support lowered in proportion to its share
   of a language's words. A phrase that is too rare in every shard is too rare in
   all of them together, so the union of the locally frequent phrases lacks none.
   A shard is mined by all tasks at once: phrases are hashes, counted within each
   chunk of text first, and dealt out by hash with those of the other shards.
   Hashes that meet can only raise a count, so none is lost by them either.
3. The union is a bitmap over the hashes (2^FILTER_BITS bits, 32 MB, whatever the
   input): it is made in slices by the tasks that own the hashes and broadcast.
4. All phrases that are in the bitmap are counted globally by their words
   themselves; those below the support go. So all counts are exact.

Tasks work through chunks of CHUNK bytes, cut where a piece of a text ends (a
piece that is longer stays whole). The shuffled rows of step 2 are blocks of
hashes, those of step 4 phrases with a chunk's counts: a very common phrase is
one entry for each chunk, never more.

Texts are lower-cased (A-Z only), split at ``[.,;:!?]`` and line ends into pieces
and at blanks and tabs into words; a phrase lies within a piece.

Defined cases: a null text is empty, a null language is UNKNOWN; empty texts and
pieces have no phrases; repeated rows and ids count each; one-word pieces have
no phrases but count as words; other columns are ignored; no rows, no phrases.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import textvec
from tidepool.llm.common import ship, written

MAX_WORDS = 4
UNKNOWN = "und"
SHARDS = 6
FILTER_BITS = 28
#: Bytes of text that a task works on at once.
CHUNK = 2_500_000
#: Bytes of a batch whose languages are told apart at once.
SLICE = 8_000_000
#: About so many hashes go into one bucket of step 2.
BUCKET_HASHES = 2_000_000
#: Bits of a hash that are counted in step 2.
KEY_BITS = 40

_U = np.uint64
#: Ends of pieces, and all bytes between words.
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[*b".,;:!?", 10, 11, 12, 13]] = True
_BETWEEN = _ENDS.copy()
_BETWEEN[[0x20, 9]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NONE = np.zeros(256, dtype=bool)


class Chunk:
    """The words of a chunk of text: their numbers in the chunk's vocabulary, and which neighbours share a piece."""

    def __init__(self, data: np.ndarray, breaks: np.ndarray):
        import pyarrow as pa

        inside, narrow = ~_BETWEEN[data], np.int32 if len(data) < 2**31 else np.int64
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | breaks[1:]
        first = np.flatnonzero(begins)
        self.n = len(first)
        piece = np.cumsum(breaks, dtype=narrow)[first]
        self.joined = piece[1:] == piece[:-1]
        letters = _LOWER[data[inside]]
        offsets = np.append(np.cumsum(inside, dtype=narrow)[first] - 1, len(letters)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), self.n, [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def places(self, n: int) -> np.ndarray:
        """Where phrases of ``n`` words begin."""
        if self.n < n:
            return np.zeros(0, dtype=np.int64)
        ok = np.ones(self.n - n + 1, dtype=bool)
        for j in range(n - 1):
            ok &= self.joined[j:self.n - n + 1 + j]
        return np.flatnonzero(ok)

    def hashes(self, n: int, places: np.ndarray, seed: np.uint64) -> np.ndarray:
        if not len(places):
            return np.zeros(0, dtype=_U)
        own = self._word_hashes()[self.ids]
        with np.errstate(over="ignore"):
            out = np.full(len(places), seed + _U(n), dtype=_U)
            for j in range(n):
                out = out * _U(0x9DDFEA08EB382D69) + own[places + j]
            return textvec.mix(out)

    def _word_hashes(self) -> np.ndarray:
        offsets = np.frombuffer(self.words.buffers()[1], dtype=np.int64)[:len(self.words) + 1]
        data = np.frombuffer(self.words.buffers()[2], dtype=np.uint8)[:offsets[-1]]
        return textvec.word_hashes(data, offsets, _NONE)[0]

    def counted(self, n: int, places: np.ndarray):
        """The different phrases of ``n`` words at these places, as an Arrow array, and how often each is there."""
        import pyarrow as pa
        import pyarrow.compute as pc

        size = np.int64(len(self.words))
        code = self.ids[places]
        for j in range(1, n):  # numbers of the different beginnings, so that the code stays small
            code = np.unique(code, return_inverse=True)[1] * size + self.ids[places + j]
        _, at, counts = np.unique(code, return_index=True, return_counts=True)
        parts = [self.words.take(pa.array(self.ids[places[at] + j])) for j in range(n)]
        phrases = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if n > 1 else parts[0]
        return phrases, counts


def chunks(texts) -> Iterator[Chunk]:
    """Chunks of an Arrow string array without nulls; none cuts a piece."""
    import pyarrow as pa

    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    breaks = _ENDS[data]
    starts = offsets[:-1] - offsets[0]
    breaks[starts[starts < len(data)]] = True
    at = 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        if end < len(data):
            inner = np.flatnonzero(breaks[at + 1:end + 1])
            if len(inner):
                end = at + 1 + int(inner[-1])
            else:
                later = np.flatnonzero(breaks[end:])
                end = end + int(later[0]) if len(later) else len(data)
        yield Chunk(data[at:end], breaks[at:end])
        at = end


def _by_language(batch) -> Iterator[tuple[str, Chunk]]:
    """The chunks of a batch of lang, text, language by language."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // SLICE)) + 1).tolist(), batch.num_rows]
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        lang, text = batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i)
        for one in pc.unique(lang).to_pylist():
            for chunk in chunks(text.filter(pc.equal(lang, one))):
                if chunk.n:
                    yield one, chunk


def _seed(lang: str) -> np.uint64:
    return textvec.hashes_of(lang, _NONE)[0] if lang else _U(0)


def _shard(shards: int) -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId() % shards


def _sizes(shards: int):
    """lang, text -> shard, lang, words."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [(lang, chunk.n) for lang, chunk in _by_language(batch)]
            langs, words = map(list, zip(*found, strict=True)) if found else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array([_shard(shards)] * len(found), pa.int32()), pa.array(langs, pa.string()),
                                              pa.array(words, pa.int64())], ["shard", "lang", "words"])
    return run


def _blocks(shards: int, bucket_bits: int, longest: int):
    """lang, text -> bucket, shard, lang and a block of the chunk's hashes with their counts."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lang, chunk in _by_language(batch):
                seed = _seed(lang)
                keys = np.concatenate([chunk.hashes(n, chunk.places(n), seed) >> _U(64 - KEY_BITS) for n in range(1, longest + 1)])
                keys.sort()
                starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                counts = np.diff(np.append(starts, len(keys))).astype(np.uint32)
                keys = keys[starts]
                bucket = (keys >> _U(KEY_BITS - bucket_bits)).astype(np.int32)
                cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                blocks = [packed(keys[i:j], counts[i:j]) for i, j in zip(cuts, [*cuts[1:], len(keys)], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cuts]), pa.array([_shard(shards)] * len(cuts), pa.int32()),
                     pa.array([lang] * len(cuts), pa.string()), pa.array(blocks, pa.binary())], ["bucket", "shard", "lang", "block"])
    return run


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Highest bytes, the rest, and counts, one array after the other."""
    return (keys >> _U(32)).astype(np.uint8).tobytes() + keys.astype(np.uint32).tobytes() + counts.tobytes()


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(block) // 9
    high = np.frombuffer(block, np.uint8, n).astype(_U) << _U(32)
    return high | np.frombuffer(block[n:5 * n], np.uint32), np.frombuffer(block[5 * n:], np.uint32)


def _union(bucket_bits: int):
    """All blocks of a bucket -> its slice of the bitmap: hashes that are frequent enough in one of the shards."""
    def run(group):
        import pyarrow as pa
        import zstandard

        bucket = group.column("bucket")[0].as_py()
        bits = np.zeros(1 << (FILTER_BITS - bucket_bits), dtype=bool)
        parts: dict[tuple, list[bytes]] = {}
        for shard, lang, least, block in zip(*(group.column(c).to_pylist() for c in ("shard", "lang", "least", "block")), strict=True):
            parts.setdefault((shard, lang, least), []).append(block)
        for (_, _, least), blocks in parts.items():
            keys, counts = map(np.concatenate, zip(*map(unpacked, blocks), strict=True))
            order = np.argsort(keys)
            keys = keys[order]
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            frequent = keys[starts][np.add.reduceat(counts[order].astype(np.int64), starts) >= least]
            bits[(frequent >> _U(KEY_BITS - FILTER_BITS)).astype(np.int64) & (len(bits) - 1)] = True
        slice_ = zstandard.compress(np.packbits(bits, bitorder="little").tobytes(), 3)
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "bits": pa.array([slice_], pa.binary())})
    return run


_FILTER: dict[str, np.ndarray] = {}


def _filter(name: str, slices, bucket_bits: int) -> np.ndarray:
    """The worker's bitmap, put together once for all its tasks."""
    if name not in _FILTER:
        import zstandard

        _FILTER.clear()
        size = 1 << (FILTER_BITS - bucket_bits - 3)
        whole = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
        for bucket, bits in slices.value:
            whole[bucket * size:(bucket + 1) * size] = np.frombuffer(zstandard.decompress(bits), np.uint8)
        _FILTER[name] = whole
    return _FILTER[name]


def _counts(slices, bucket_bits: int, longest: int):
    """lang, text -> lang, phrase, words in it, and how often the chunk has it, for phrases in the bitmap."""
    name = uuid.uuid4().hex

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        bitmap = _filter(name, slices, bucket_bits)
        loose = pc.CastOptions(pa.string(), allow_invalid_utf8=True)
        for batch in batches:
            for lang, chunk in _by_language(batch):
                seed = _seed(lang)
                for n in range(1, longest + 1):
                    places = chunk.places(n)
                    bit = chunk.hashes(n, places, seed) >> _U(64 - FILTER_BITS)
                    places = places[bitmap[(bit >> _U(3)).astype(np.int64)] >> (bit & _U(7)).astype(np.uint8) & 1 > 0]
                    if not len(places):
                        continue
                    phrases, counts = chunk.counted(n, places)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(counts), pa.string()), pc.cast(phrases, options=loose),
                         pa.array(np.full(len(counts), n, np.int32)), pa.array(counts.astype(np.int64))],
                        ["lang", "phrase", "k", "f"])
    return run


def frequent_phrases(docs: DataFrame, min_count: int, longest: int = MAX_WORDS, lang_col: str = "lang",
                     text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f): phrases of 1 to ``longest`` words that occur ``min_count`` times or more; and (lang, n) words."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sizes = written(texts.mapInArrow(_sizes(SHARDS), "shard int, lang string, words long").groupBy("shard", "lang")
                    .agg(F.sum("words").alias("words")), "phrases-sizes")
    words = sizes.groupBy("lang").agg(F.sum("words").alias("n"))
    least = F.expr(f"CAST((CAST(words AS DECIMAL(38,0)) * {min_count} + n - 1) div n AS BIGINT)")
    support = written(sizes.join(words, "lang").select("shard", "lang", least.alias("least")), "phrases-support")

    total = sizes.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    bucket_bits = min(max(4, (total * longest // BUCKET_HASHES).bit_length()), FILTER_BITS - 3)
    blocks = texts.mapInArrow(_blocks(SHARDS, bucket_bits, longest), "bucket int, shard int, lang string, block binary")
    supported = blocks.join(support, ["shard", "lang"], "left").withColumn("least", F.coalesce("least", F.lit(1).cast("long")))
    found = supported.groupBy("bucket").applyInArrow(_union(bucket_bits), "bucket int, bits binary").collect()  # the whole bitmap at most
    slices = spark.sparkContext.broadcast([(r.bucket, bytes(r.bits)) for r in found])

    counted = texts.mapInArrow(_counts(slices, bucket_bits, longest), "lang string, phrase string, k int, f long")
    frequent = counted.groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)
    return written(frequent, "phrases-frequent"), words


def collocations(docs: DataFrame, min_count: int = 30, top: int = 2000, share: int = 80, longest: int = MAX_WORDS,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its two parts at the
    cut with the lowest score floor(2000000 a / (l + r)). Phrases inside a longer
    one that has ``share`` percent of their count or more are left out.
    """
    frequent, words = frequent_phrases(docs, min_count, longest, lang_col, text_col)
    listed = frequent.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def joined(begin, length):
        return F.array_join(F.slice("w", begin, length), " ")

    cuts = (listed.select("lang", "phrase", "k", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
            .select("lang", "phrase", "a", "cut", joined(F.lit(1), F.col("cut")).alias("left"), joined(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right")))
    part = lambda name, count: frequent.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    score = F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    scored = (cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("s")))

    spans = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("k") - size + 1), lambda begin: F.array_join(F.slice(F.col("w"), begin, size), " ")))))
    inside = listed.where("k > 2").select("lang", "a", spans.alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    kept = scored.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * share))

    order = Window.partitionBy("lang").orderBy(F.desc("s.score"), F.desc("a"), F.asc("phrase"))
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "s.l", "s.r", "n",
                                           F.col("s.score").cast("long").alias("score"))


def oracle_sql(min_count: int = 30, top: int = 2000, share: int = 80) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '{UNKNOWN}') AS lang,
         regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]') AS pieces
  FROM documents
), pieces AS (
  SELECT row, lang, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS p FROM texts
), worded AS (
  SELECT row, lang, p, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), words AS (
  SELECT row, lang, p, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM worded WHERE len(w) > 0
), grams AS (
  SELECT lang, w1, lead(w1, 1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3, lead(w1, 3) OVER piece AS w4
  FROM words WINDOW piece AS (PARTITION BY row, p ORDER BY i)
), phrases AS (
  SELECT lang, w1 AS phrase, 1 AS k FROM grams
  UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM grams WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM grams WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4 FROM grams WHERE w4 IS NOT NULL
), f AS (
  SELECT lang, phrase, k, count(*) AS f FROM phrases GROUP BY ALL HAVING count(*) >= {min_count}
), listed AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), cuts AS (
  SELECT lang, phrase, k, a, w, unnest(range(1, k)) AS cut FROM listed
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), spans AS (
  SELECT lang, a, w, k, unnest(range(2, k)) AS size FROM listed
), begins AS (
  SELECT lang, a, w, size, unnest(range(1, k - size + 2)) AS b FROM spans
), inside AS (
  SELECT lang, array_to_string(w[b:b + size - 1], ' ') AS phrase, max(a) AS longer FROM begins GROUP BY ALL
), kept AS (
  SELECT s.* FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < {share} * s.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
), n AS (SELECT lang, count(*) AS n FROM words GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {top}"""
