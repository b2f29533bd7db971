"""A source and a sink by format name (SRC1/SRC2, SNK5/SNK7), as Spark data sources in Python.

``tail_lines`` reads the lines that have been appended to growing files, which
the file source never reads again: its offset is a byte position for each file,
after the last complete line. So a query goes on in the middle of a file after a
restart, and a line that is still being written waits.

``committed_rows`` writes rows in two phases: tasks write files, and the driver
names those of a batch in one commit file. Readers see the files of commits only,
so a failed batch leaves nothing and a replayed one a single copy.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceStreamWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from tidepool.session import ship_code

#: Bytes of a file that one task reads, and that are read at once.
SPLIT, CHUNK = 64 << 20, 1 << 20
#: Rows in one piece of a written file.
ROWS_AT_ONCE = 10_000


def _file_system(path: str):
    """The file system of a path or URI, and the path within it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- tail_lines
class Range(InputPartition):
    """Bytes of a file; its lines begin there."""

    def __init__(self, file: str, begin: int, end: int, inner: bool):
        self.file, self.begin, self.end, self.inner = file, begin, end, inner


class TailLines(DataSource):
    """``line``, with the ``file`` and the ``offset`` of its first byte."""

    @classmethod
    def name(cls) -> str:
        return "tail_lines"

    def schema(self) -> str:
        return "line string, file string, offset bigint"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802 - Spark API
        return TailReader(self.options)


class TailReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))
        self.known: dict[str, tuple[int, int]] = {}  # of a file: its size when seen last, and the end of its last line then

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        from pyarrow import fs as pafs

        fs, base = _file_system(self.path)
        top = fs.get_file_info(base)
        found = [top] if top.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
        out = {}
        for info in found:
            if info.type != pafs.FileType.File or info.base_name[0] in "._":
                continue
            size, end = self.known.get(info.path, (-1, 0))
            if size != info.size:
                end = self._last_line_end(fs, info.path, info.size)
                self.known[info.path] = (info.size, end)
            out[info.path] = end
        return out

    @staticmethod
    def _last_line_end(fs, path: str, size: int) -> int:
        with fs.open_input_file(path) as f:
            end = size
            while end > 0:
                begin = max(0, end - CHUNK)
                at = f.read_at(end - begin, begin).rfind(b"\n")
                if at >= 0:
                    return begin + at + 1
                end = begin
        return 0

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        out = []
        for file, stop in sorted(end.items()):
            begin = start.get(file, 0)
            if stop < begin:
                begin = 0  # the file was cut or replaced
            for at in range(begin, stop, self.split):
                out.append(Range(file, at, min(at + self.split, stop), at > begin))
        return out

    def read(self, partition: Range) -> Iterator[tuple]:
        """Lines that begin in the range; one that began before an inner range belongs to the range before."""
        fs, _ = _file_system(self.path)
        with fs.open_input_file(partition.file) as f:
            at = partition.begin - 1 if partition.inner else partition.begin
            size, rest, skip = f.size(), b"", partition.inner
            place = at
            while place < partition.end and at < size:
                chunk = f.read_at(min(CHUNK, size - at), at)
                at += len(chunk)
                *lines, rest = (rest + chunk).split(b"\n")
                for line in lines:
                    if place >= partition.end:
                        return
                    if skip:
                        skip = False
                    else:
                        yield line.removesuffix(b"\r").decode("utf-8", "replace"), partition.file, place
                    place += len(line) + 1

    def commit(self, end: dict) -> None:
        pass


def tail_lines(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """A stream of the lines of the files under ``path``, old and new ones, as they grow; arrival time as ``ts``."""
    ship_code(spark)
    spark.dataSource.register(TailLines)
    return (spark.readStream.format("tail_lines").option("path", path).option("split", str(split)).load()
            .withColumn("ts", F.current_timestamp()))


# ------------------------------------------------------------ committed_rows
@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class CommittedRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed_rows"

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:  # noqa: N802
        return RowsWriter(self.options["path"], schema)


class RowsWriter(DataSourceStreamWriter):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path.rstrip("/"), schema

    def write(self, iterator) -> WriterCommitMessage:
        import pyarrow as pa
        from pyarrow import parquet
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, base = _file_system(self.path)
        schema, names = to_arrow_schema(self.schema), self.schema.names
        file, rows, out, total = f"data/{uuid.uuid4().hex}.parquet", [], None, 0

        def flushed():
            nonlocal out, rows, total
            if rows:
                if out is None:
                    fs.create_dir(f"{base}/data", recursive=True)
                    out = parquet.ParquetWriter(f"{base}/{file}", schema, filesystem=fs)
                out.write_table(pa.Table.from_pylist(rows, schema))
                total += len(rows)
                rows = []

        for row in iterator:
            rows.append(dict(zip(names, row, strict=True)))
            if len(rows) >= ROWS_AT_ONCE:
                flushed()
        flushed()
        if out is not None:
            out.close()
        return Written(file if total else None, total)

    def commit(self, messages, batchId: int) -> None:  # noqa: N803
        """One file names the batch's files; those of an earlier attempt go."""
        fs, base = _file_system(self.path)
        fs.create_dir(f"{base}/commits", recursive=True)
        name, files = f"{base}/commits/{batchId:012d}.json", [m.file for m in messages if m is not None and m.file]
        before = _commit(fs, name)
        with fs.open_output_stream(f"{base}/.commit-{batchId}") as f:
            f.write(json.dumps({"batch_id": batchId, "files": files, "rows": sum(m.rows for m in messages if m is not None)}).encode())
        fs.move(f"{base}/.commit-{batchId}", name)
        for old in set(before) - set(files):
            fs.delete_file(f"{base}/{old}")

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        fs, base = _file_system(self.path)
        for m in messages:
            if m is not None and m.file:
                fs.delete_file(f"{base}/{m.file}")


def _commit(fs, name: str) -> list[str]:
    from pyarrow import fs as pafs

    if fs.get_file_info(name).type != pafs.FileType.File:
        return []
    with fs.open_input_file(name) as f:
        return json.loads(f.read())["files"]


def write_committed(df: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str = "1 second"):
    """Start a query that writes ``df`` with ``committed_rows``."""
    spark = df.sparkSession
    ship_code(spark)
    spark.dataSource.register(CommittedRows)
    writer = df.writeStream.format("committed_rows").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def read_committed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all commits."""
    from pyarrow import fs as pafs

    fs, base = _file_system(path)
    commits = fs.get_file_info(pafs.FileSelector(f"{base}/commits", allow_not_found=True))
    files = [f"{path.rstrip('/')}/{name}" for c in commits if c.type == pafs.FileType.File for name in _commit(fs, c.path)]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)

# Spark's Python workers on the driver don't get shipped files: what they need goes along by value.
register_pickle_by_value(sys.modules[__name__])
