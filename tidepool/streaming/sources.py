"""Line and record sources (SRC1-SRC6) as DataFrame readers.

Every source yields the same shapes as the batch fixtures (``line`` /
``text`` plus an event time ``ts``), so the operators do not care where rows
come from. Socket and Kafka readers only build options here: the socket source
is not replayable (use it for demos only) and the Kafka connector jar is not
bundled; recovery after a lost executor relies on a replayable source (files
or Kafka) plus the query checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_SCHEMA = "line string, ts timestamp"
STATUS_SCHEMA = "text string, ts timestamp"


def socket_options(host: str = "127.0.0.1", port: int = 9999) -> dict:
    """SRC1/SRC2: options for ``readStream.format('socket')``."""
    return {"host": host, "port": str(port), "includeTimestamp": "true"}


def socket_lines(spark: SparkSession, host: str = "127.0.0.1", port: int = 9999) -> DataFrame:
    """SRC1/SRC2: one row per received line; arrival time as ``ts``."""
    raw = spark.readStream.format("socket").options(**socket_options(host, port)).load()
    return raw.select(F.col("value").alias("line"), F.col("timestamp").alias("ts"))


def kafka_options(brokers: str = "localhost:9092", topics: str = "testLogs",
                  starting: str = "latest") -> dict:
    """SRC3: options for ``readStream.format('kafka')`` (value only is used)."""
    return {"kafka.bootstrap.servers": brokers, "subscribe": topics,
            "startingOffsets": starting}


def kafka_lines(spark: SparkSession, brokers: str = "localhost:9092",
                topics: str = "testLogs") -> DataFrame:
    """SRC3: message values as lines, broker timestamp as ``ts``."""
    raw = spark.readStream.format("kafka").options(**kafka_options(brokers, topics)).load()
    return raw.select(F.col("value").cast("string").alias("line"), F.col("timestamp").alias("ts"))


def status_files(spark: SparkSession, path: str, fmt: str = "json",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC4 re-aimed: status records ``(text, ts)`` landing as JSON/parquet files."""
    r = spark.readStream.schema(STATUS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.format(fmt).load(path)


def stream_path(path: str) -> str:
    """The file source wants a directory or a glob; a single file becomes a
    glob that matches only itself (``a.parquet`` -> ``a.parque[t]``)."""
    if any(ch in path for ch in "*?[{"):
        return path
    leaf = path.rstrip("/").rsplit("/", 1)[-1]
    if "." in leaf:
        return path[:-1] + "[" + path[-1] + "]"
    return path


def table_stream(spark: SparkSession, path: str, schema,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC5: a parquet path (file, directory or glob) replayed as a stream."""
    path = stream_path(path)
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def text_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """SRC6: text files (CRLF tolerated: a trailing CR is removed)."""
    reader = spark.readStream if stream else spark.read
    df = reader.text(path)
    return df.select(F.regexp_replace("value", "\r$", "").alias("line"))
