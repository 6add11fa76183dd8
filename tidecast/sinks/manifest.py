"""A table of batch parts that readers follow by manifests, with compaction by key.

Each micro-batch writes a part, a folder of its own, and publishes it with a new manifest,
the list of the table's parts. A manifest appears as a whole or not at all and never
changes, so a reader sees one state of the table while parts are written and merged.

Small parts are merged level by level: as soon as ``fan`` parts of one level follow each
other, they become one part of the next, with the newest row per key. So a table of n
batches has at most ``fan - 1`` parts on each of log(n) levels, and a row is rewritten
once a level.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import BatchWriter, latest_by

BATCH = "batch"


@dataclass(frozen=True)
class Part:
    """A folder with the rows of the batches ``first`` to ``last``."""

    name: str
    first: int
    last: int
    level: int
    size: int


class Conflict(RuntimeError):
    """Another writer has published the version first."""


class ManifestTable:
    """Rows of ``schema`` below ``path``, of which the newest per ``keys`` stands.

    ``order`` are the columns that tell the newest, the batch decides among equals.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        order: Sequence[str] = (),
        fan: int = 4,
        file_bytes: int = 128 << 20,
    ) -> None:
        if fan < 2:
            raise ValueError("a merge takes two parts at least")
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        self.keys, self.order, self.fan, self.file_bytes = list(keys), list(order), fan, file_bytes
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    # Manifests.

    def _file(self, *names: str):
        return self._hadoop.Path("/".join((self.path, *names)))

    def _files(self):
        return self._file().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder, files = self._file("manifests"), self._files()
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def parts(self, version: int | None = None) -> list[Part]:
        """Parts of a version, of the newest one by default."""
        if version is None:
            version = max(self.versions(), default=-1)
        if version < 0:
            return []
        text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(
            self._files().open(self._file("manifests", str(version))), "UTF-8"
        )
        return [Part(**p) for p in json.loads(text)]

    def publish(self, parts: Sequence[Part], version: int) -> None:
        """Make ``parts`` the table's version; :class:`Conflict` if there is one already."""
        files = self._files()
        draft = self._file("manifests", f"_{uuid.uuid4().hex}")
        out = files.create(draft)
        out.write(json.dumps([asdict(p) for p in parts]).encode())
        out.close()
        context = self._hadoop.FileContext.getFileContext(
            files.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        none = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 0)
        try:
            # Unlike a plain move this one refuses to replace a file.
            context.rename(draft, self._file("manifests", str(version)), none)
        except Exception as error:
            files.delete(draft, False)
            if version in self.versions():
                raise Conflict(f"version {version} of {self.path} is taken") from error
            raise

    # Writing.

    def _written(self, rows: DataFrame, first: int, last: int, level: int) -> Part:
        name = f"{first}-{last}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/parts/{name}")
        size = self._files().getContentSummary(self._file("parts", name)).getLength()
        return Part(name, first, last, level, size)

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Add a batch. One that was added before is replaced, or skipped once merged."""
        version = max(self.versions(), default=-1)
        parts = self.parts(version)
        if any(p.level and p.first <= batch_id <= p.last for p in parts):
            return
        numbered = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")).to(self.schema)
        new = self._written(numbered, batch_id, batch_id, 0)
        others = [p for p in parts if p.level or p.first != batch_id]
        self.publish(sorted([*others, new], key=lambda p: p.first), version + 1)
        self.compact()

    def writer(self, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> BatchWriter:
        """A ``foreachBatch`` function that appends shaped rows."""
        return lambda batch, batch_id: self.append(shape(batch), batch_id)

    def compact(self) -> None:
        """Merge until no level has ``fan`` parts."""
        while True:
            version = max(self.versions(), default=-1)
            parts = self.parts(version)
            levels = sorted({p.level for p in parts})
            full = [level for level in levels if sum(p.level == level for p in parts) >= self.fan]
            if not full:
                return
            chosen = [p for p in parts if p.level == full[0]][: self.fan]
            merged = self._merged(chosen, full[0] + 1)
            kept = [p for p in parts if p not in chosen]
            self.publish(sorted([*kept, merged], key=lambda p: p.first), version + 1)

    def _merged(self, chosen: Sequence[Part], level: int) -> Part:
        rows = self._rows(chosen)
        newest = latest_by(rows, self.keys, [*self.order, BATCH])
        files = -(-sum(p.size for p in chosen) // self.file_bytes)
        # Files of neighbouring keys, which their smallest and largest keys tell apart.
        dealt = newest.repartitionByRange(max(1, files), *self.keys)
        first, last = min(p.first for p in chosen), max(p.last for p in chosen)
        return self._written(dealt.sortWithinPartitions(*self.keys), first, last, level)

    def vacuum(self, keep: int = 2) -> int:
        """Delete what only older versions than the last ``keep`` list; number of parts deleted."""
        versions, files = self.versions(), self._files()
        used = {p.name for v in versions[-keep:] for p in self.parts(v)}
        old = {p.name for v in versions[:-keep] for p in self.parts(v)} - used
        for name in old:
            files.delete(self._file("parts", name), True)
        for version in versions[:-keep]:
            files.delete(self._file("manifests", str(version)), False)
        return len(old)

    # Reading.

    def _rows(self, parts: Sequence[Part]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        folders = [f"{self.path}/parts/{p.name}" for p in parts]
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest row per key of a version, with the batch that wrote it."""
        return latest_by(self._rows(self.parts(version)), self.keys, [*self.order, BATCH])
