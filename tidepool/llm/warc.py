"""WARC archives with revisit records, and an index of globally ordered capture histories.

Writing: each page is one WARC/1.1 record. Of equal payloads, the page with the
smallest id is the response and holds the payload; the others are revisit
records that name it. Spark's text writer puts the records into files, with the
record terminator as line separator, so files are committed like any Spark
output and lost tasks are simply repeated.

Reading: each archive is walked record by record by its Content-Length (never
by searching for a separator, which a payload may contain).

Index: *external index merge*. Every reading task sorts its captures into a run;
the runs are a table in the shared folder. Spark cuts the key space (url key,
timestamp, page id) into ranges; each range gets its slice of every run, and a
loser tree merges the slices. A range holds about RANGE_ENTRIES entries even if
one url makes up most of the captures, as timestamp and page id are in the key.

Defined cases: a null html is an empty payload; a null url gives an empty url
key; a page with a null id is never the response of others (alone with its
payload, it is a response); repeated rows of one id and payload are all
responses; extra columns are ignored; no pages, no records and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import ship, written
from tidepool.session import shared_dir

#: Payloads of fewer bytes are always written in full.
LEAST_BYTES = 0
#: Most records in an archive file; about as many index entries in a merged range.
FILE_RECORDS, RANGE_ENTRIES = 1_000, 100_000
#: Payloads of more bytes go to archives of their own, which hold about so many bytes at most (or one record).
LARGE_BYTES, FILE_BYTES = 500_000, 500_000_000
#: Capture time of pages that have none of their own.
CAPTURED = "2024-01-01T00:00:00Z"

#: Digits of base 32 as ``conv`` writes them, and as RFC 4648 does.
_CONV_DIGITS, _RFC_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n\r\n"

INDEX_SCHEMA = ("url_key string, captured string, page_id long, payload_bytes long, payload_digest string, "
                "record_type string, refers_to long, file string, offset long, record_bytes long")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1: every five hex digits are four base-32 ones."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _CONV_DIGITS, _RFC_DIGITS)


def url_key(url: Column) -> Column:
    """Host labels from the top level down, then path and query: ``com,example,www)/a?b``; null or no host: empty."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest))


def with_record_types(pages: DataFrame, id_col: str, url_col: str, html_col: str, captured: Column,
                      least_bytes: int) -> DataFrame:
    """page_id, url, captured, payload, payload_bytes, payload_digest, record_type, refers_to."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        captured.alias("captured"), F.coalesce(F.col(html_col), F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                             "payload_digest": base32_sha1(F.col("payload"))})
    # only payloads that occur more than once matter to the join; a page's first is its own
    shared = (rows.groupBy("payload_digest", "payload_bytes")
              .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
              .where((F.col("n") > 1) & F.col("first_id").isNotNull() & (F.col("payload_bytes") >= least_bytes))
              .drop("n"))
    shared = written(shared, "warc-shared")  # now Spark knows its size: broadcast only if small
    rows = rows.join(shared, ["payload_digest", "payload_bytes"], "left")
    again = F.col("first_id").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")))
    return rows.withColumns({"record_type": F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
                             "refers_to": F.when(again, F.col("first_id"))}).drop("first_id")


def _record(row: dict[str, Column]) -> Column:
    """One record without its terminator."""
    revisit = row["record_type"] == "revisit"
    status = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
                      row["payload_bytes"].cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(status, F.when(revisit, F.lit("")).otherwise(row["payload"]))
    uri = F.regexp_replace(F.coalesce(row["url"], F.lit("")), r"[\r\n]", "")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    page = F.coalesce(row["page_id"].cast("string"), F.concat(F.lit("none:"), row["payload_digest"]))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", row["record_type"]),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        line("WARC-Date", row["captured"]),
        F.when(row["url"].isNotNull(), line("WARC-Target-URI", uri)).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), row["payload_digest"])),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), row["refers_to"].cast("string"), F.lit(">"))))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               captured: Column | None = None, least_bytes: int = LEAST_BYTES) -> None:
    """Write the pages as WARC files under ``path``."""
    captured = F.lit(CAPTURED) if captured is None else captured
    rows = with_record_types(pages, id_col, url_col, html_col, captured, least_bytes)
    most = pages.agg(F.max(F.octet_length(F.col(html_col)))).first()[0] or 0
    large = F.col("payload_bytes") > LARGE_BYTES
    # an archive is read by one task, as one value
    sizes = [(~large, FILE_RECORDS), (large, max(1, FILE_BYTES // most))] if most > LARGE_BYTES else [(F.lit(True), FILE_RECORDS)]
    for some, records in sizes:
        (rows.where(some).select(_record({c: F.col(c) for c in rows.columns}).alias("value"))
         .write.mode("append").option("lineSep", _END).option("maxRecordsPerFile", records).text(path))


def walk_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, bytes, headers, block) of each record of an archive."""
    at, n = 0, len(data)
    while at < n:
        top = data.index(b"\r\n\r\n", at)
        lines = data[at:top].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        end = top + 4 + int(headers["content-length"])
        yield at, end + 4 - at, headers, data[top + 4:end]
        at = end + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The index entries of all archives under ``path``: INDEX_SCHEMA with ``url`` for the url key.

    A response's size and digest are taken anew from its payload; a revisit's
    from its headers. A response whose digest does not fit ends the job.
    """
    ship(spark)

    def run(batches: Iterator) -> Iterator:
        import base64
        import hashlib

        import pyarrow as pa

        page_of = lambda x: int(x[10:-1]) if x and not x.startswith("<urn:page:none:") else None
        fields = _arrow_schema().names[:-2]
        for batch in batches:
            for name, content in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                rows = []
                for offset, size, headers, block in walk_records(content):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
                    length = int(http.rpartition(b"Content-Length: ")[2])
                    if kind == "response":
                        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if (found, len(payload)) != (digest, length):
                            raise ValueError(f"{name}, byte {offset}: the payload doesn't fit its digest")
                    rows.append((headers.get("warc-target-uri"), headers["warc-date"], page_of(headers["warc-record-id"]),
                                 length, digest, kind, page_of(headers.get("warc-refers-to")), name.rpartition("/")[2],
                                 offset, size))
                schema = pa.schema([_arrow_schema().field(c).with_name("url" if c == "url_key" else c) for c in fields])
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

    schema = INDEX_SCHEMA.replace("url_key", "url")
    files = spark.read.format("binaryFile").load(path).select("path", "content").where("length > 0")
    return files.mapInArrow(run, schema)


class LoserTree:
    """Merges sorted lists: each inner node keeps the loser of its match, so a step replays one path."""

    def __init__(self, runs: list[list]):
        self.runs = [iter(r) for r in runs]
        self.k = len(runs)
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * max(self.k, 1)
        self.winner = -1
        for i in range(self.k):
            self._enter(i)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _enter(self, i: int) -> None:
        """Play ``i`` up from its leaf; while the tree is filled, wait at the first empty node."""
        node = (i + self.k) >> 1
        while node:
            if self.losers[node] < 0:
                self.losers[node] = i
                return
            if self._beats(self.losers[node], i):
                self.losers[node], i = i, self.losers[node]
            node >>= 1
        self.winner = i

    def __iter__(self) -> Iterator:
        while self.k and (head := self.heads[self.winner]) is not None:
            yield head
            i = self.winner
            self.heads[i] = next(self.runs[i], None)
            node = (i + self.k) >> 1
            while node:
                if self._beats(self.losers[node], i):
                    self.losers[node], i = i, self.losers[node]
                node >>= 1
            self.winner = i


_ORDER = ["url_key", "captured", "page_id", "file", "offset"]
_RANGE_SCHEMA = INDEX_SCHEMA + ", range int, place long"


def _merge_range(batches: Iterator) -> Iterator:
    """One range: its slices of the runs, in any order, merged to one ordered list."""
    import pyarrow as pa
    from pyspark import TaskContext

    number, runs, rows, last = TaskContext.get().partitionId(), [], [], None
    for batch in batches:
        base = len(rows)
        columns = [batch.column(c).to_pylist() for c in _ORDER]
        rows += batch.to_pylist()
        for i, key in enumerate(zip(*columns, strict=True)):
            key = (key[0], key[1], -1 << 63 if key[2] is None else key[2], key[3], key[4])
            if last is None or key < last:
                runs.append([])
            runs[-1].append((key, base + i))
            last = key
    merged = [rows[i] | {"range": number, "place": place} for place, (_, i) in enumerate(LoserTree(runs))]
    for start in range(0, len(merged), 10_000):
        yield pa.RecordBatch.from_pylist(merged[start:start + 10_000], schema=_arrow_schema())


def _arrow_schema():
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in _RANGE_SCHEMA.split(", "))])


def capture_index(entries: DataFrame) -> DataFrame:
    """The entries of ``read_warc`` as one globally ordered index: adds ``position``, from 0.

    Sorted runs, one for each reading task, and the merged ranges are tables in
    the shared folder; only a row for each range meets in one task.
    """
    spark = entries.sparkSession
    ship(spark)
    keyed = entries.withColumn("url", url_key(F.col("url"))).withColumnRenamed("url", "url_key")
    runs = written(keyed.sortWithinPartitions(*_ORDER), "warc-runs")
    ranges = runs.count() // RANGE_ENTRIES + 1
    merged = written(runs.repartitionByRange(ranges, *_ORDER).mapInArrow(_merge_range, _RANGE_SCHEMA), "warc-index")
    counts = merged.groupBy("range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("range", before.alias("start"))
    return merged.join(starts, "range").withColumn("position", F.col("start") + F.col("place")).drop("range", "place", "start")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages' archives, read them back, and give each page's record and place in the index."""
    path = shared_dir(pages.sparkSession, "warc")
    write_warc(pages, path)
    index = capture_index(read_warc(pages.sparkSession, path))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "position")


#: The digest's base 32 comes from its bits, five at a time; repeated rows of one id and payload are all responses.
ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hexed FROM pages),
r AS (
  SELECT *, octet_length(payload) AS payload_bytes,
    min(page_id) OVER (PARTITION BY hexed, octet_length(payload)) AS first_id,
    lower(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)) AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^#]*)', 1) AS rest
  FROM p),
k AS (
  SELECT *, CASE WHEN host = '' THEN '' ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || rest END AS url_key,
    first_id IS NOT NULL AND payload_bytes >= {LEAST_BYTES} AND page_id IS DISTINCT FROM first_id AS again
  FROM r)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{_RFC_DIGITS}', 1 + (
    (('0x' || substr(hexed, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31)::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first_id END AS refers_to, url_key,
  row_number() OVER (ORDER BY url_key, page_id NULLS FIRST) - 1 AS position
FROM k
"""
