"""Helpers shared by the operators: inputs, shipping code, written tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import shared_dir

#: A word: a run of characters other than the six ASCII white-space ones.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    to = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{root.name}.zip")
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(to)
    _SHIPPED.add(app)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, safe from lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def rows_at_once(spark: SparkSession, n: int) -> Iterator[None]:
    """Writes within it hand at most ``n`` rows at once to Python: for rows that hold long texts."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(n))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def dropped(table: DataFrame) -> None:
    """Remove a table of ``written`` that nothing reads any more."""
    spark = table.sparkSession
    for path in {name.rpartition("/")[0] for name in table.inputFiles()}:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text (null: empty), whatever else the table holds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def blocks(batch, most: int) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of an Arrow batch of ``id_text``, cut to about ``most`` characters; a text stays whole."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        ids.append(doc_id)
        texts.append(text)
        size += len(text)
        if size >= most:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts
