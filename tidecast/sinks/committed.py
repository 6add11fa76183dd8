"""Files of a stream that appear batch by batch, by a commit protocol.

``spark.dataSource.register(CommittedFiles)`` makes the format ``committed_files``. Tasks
stage Parquet files below ``path``; when all have succeeded the driver publishes the batch
by one small file that lists them. Files that no list names are never read: those of tasks
that were tried again, of batches that were given up, and of batches that were published
before and run again.

``path`` must be a folder that all machines share, by a name that pyarrow can open.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file://" + path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path)


@dataclass
class Staged(WriterCommitMessage):
    """The files that one task has written."""

    files: list[str]
    rows: int


class CommittedWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, rows_per_file: int) -> None:
        self.path, self.rows_per_file = path, rows_per_file

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        files, root = _opened(self.path)
        files.create_dir(f"{root}/data", recursive=True)
        names, rows, writer, held = [], 0, None, 0
        try:
            for batch in iterator:
                if batch.num_rows == 0:
                    continue
                if writer is None:
                    # The name is the task's own, also when the task is tried again.
                    names.append(f"{uuid.uuid4().hex}.parquet")
                    writer, held = pq.ParquetWriter(f"{root}/data/{names[-1]}", batch.schema, filesystem=files), 0
                writer.write_batch(batch)
                held, rows = held + batch.num_rows, rows + batch.num_rows
                if held >= self.rows_per_file:
                    writer.close()
                    writer = None
        finally:
            if writer is not None:
                writer.close()
        return Staged(names, rows)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        files, root = _opened(self.path)
        files.create_dir(f"{root}/commits", recursive=True)
        listed = f"{root}/commits/{batchId}"
        staged = [m for m in messages if m is not None]
        if files.get_file_info(listed).type != pafs.FileType.NotFound:
            self._drop(staged)
            return
        draft = f"{root}/commits/_{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write(json.dumps({"files": [f for m in staged for f in m.files], "rows": sum(m.rows for m in staged)}).encode())
        files.move(draft, listed)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self._drop([m for m in messages if m is not None])

    def _drop(self, staged: list[Staged]) -> None:
        files, root = _opened(self.path)
        for name in (f for m in staged for f in m.files):
            files.delete_file(f"{root}/data/{name}")


class CommittedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed_files"

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        if overwrite:
            raise ValueError("committed_files only appends")
        rows = self.options.get("rowsperfile", self.options.get("rowsPerFile", "5000000"))
        return CommittedWriter(self.options["path"], int(rows))


def published(path: str) -> dict[int, dict]:
    """The lists of all published batches: their files and how many rows they hold."""
    files, root = _opened(path)
    if files.get_file_info(f"{root}/commits").type == pafs.FileType.NotFound:
        return {}
    found = {}
    for info in files.get_file_info(pafs.FileSelector(f"{root}/commits")):
        if info.base_name.isdigit():
            with files.open_input_stream(info.path) as lines:
                found[int(info.base_name)] = json.loads(lines.read())
    return found


def read_published(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all published batches."""
    names = [f"{path}/data/{f}" for _, batch in sorted(published(path).items()) for f in batch["files"]]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*names)
