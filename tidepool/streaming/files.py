"""Small files of the driver in the shared folder, through the file systems that Spark itself uses."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_json(spark: SparkSession, path: str, value) -> None:
    """Written beside its place first, so a reader finds the old file or the new one."""
    beside, fs = _path(spark, f"{path}.new")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()
    where, _ = _path(spark, path)
    fs.delete(where, False)
    fs.rename(beside, where)


def read_json(spark: SparkSession, path: str):
    """None if there is no such file; a write that was cut off leaves the file beside its place."""
    for name in (path, f"{path}.new"):
        where, fs = _path(spark, name)
        if fs.exists(where):
            stream = fs.open(where)
            try:
                raw = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
            finally:
                stream.close()
            return json.loads(bytes(raw).decode())
    return None


def delete(spark: SparkSession, path: str) -> None:
    where, fs = _path(spark, path)
    fs.delete(where, True)


class RunningTotals:
    """Sums over micro-batches in one small file; a replayed batch replaces its own share."""

    def __init__(self, spark: SparkSession, path: str, size: int):
        self.spark, self.path = spark, path
        kept = read_json(spark, path) or {"batch": -1, "before": [0] * size, "after": [0] * size}
        self.batch, self.before, self.after = kept["batch"], kept["before"], kept["after"]

    def add(self, batch_id: int, values) -> None:
        if batch_id < self.batch:
            return  # counted long ago
        if batch_id > self.batch:
            self.before = self.after
        self.batch, self.after = batch_id, [a + v for a, v in zip(self.before, values, strict=True)]
        write_json(self.spark, self.path, {"batch": self.batch, "before": self.before, "after": self.after})

    def upto(self, batch_id: int) -> list:
        """Totals before a batch, whether it has been counted already or not."""
        return self.before if batch_id == self.batch else self.after
