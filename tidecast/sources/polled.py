"""A database table polled for its changes, as a streaming source.

``spark.dataSource.register(PolledTable)`` makes the format ``polled_table``. A stream's
offset is the time of the last change it has read, so a micro-batch holds the rows changed
since, and a restart goes on from there. The first batch leaves out deleted rows; later
ones hold them with their mark, so that deletes come through.

Options: ``module`` (a driver module of Python's database interface), ``connect`` (JSON of
its connection's arguments by name), ``dbtable``, ``key`` (a whole number, by whose ranges
a batch is read in ``numPartitions`` tasks), ``updated`` and ``deleted``. The schema is
given to the reader; its columns are those read.
"""

from __future__ import annotations

import importlib
import json
import re
import sys
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# The source travels to the executors with its code.
cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])

#: What stands for a parameter, by the driver module's style.
PLACEHOLDERS = {"qmark": "?", "format": "%s", "pyformat": "%s"}
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def _checked(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"{name!r} is no name of a table or column")
    return name


class Changes:
    """Queries for the changes of one table."""

    def __init__(self, options: dict, schema: T.StructType) -> None:
        self.module, self.connect = options["module"], json.loads(options.get("connect", "{}"))
        names = {n: options.get(n, default) for n, default in (
            ("dbtable", None), ("key", "id"), ("updated", "updateTime"), ("deleted", "deleted")
        )}
        if names["dbtable"] is None:
            raise ValueError("option dbtable is missing")
        self.table, self.key, self.updated, self.deleted = (_checked(names[n]) for n in names)
        self.columns = [_checked(f.name) for f in schema.fields]
        self.tasks = int(options.get("numpartitions", options.get("numPartitions", "4")))

    def rows(self, what: str, conditions: list[tuple[str, object]]) -> Iterator[tuple]:
        driver = importlib.import_module(self.module)
        mark = PLACEHOLDERS[driver.paramstyle]
        where = " AND ".join(f"{text} {mark}" for text, _ in conditions)
        query = f"SELECT {what} FROM {self.table}" + (f" WHERE {where}" if where else "")
        with closing(driver.connect(**self.connect)) as connection, closing(connection.cursor()) as cursor:
            cursor.execute(query, [value for _, value in conditions])
            # A few rows at a time, however many there are.
            while found := cursor.fetchmany(10_000):
                yield from found

    def between(self, since, until) -> list[tuple[str, object]]:
        known = [(f"{self.deleted} =", 0)] if since is None else [(f"{self.updated} >", since)]
        return [*known, (f"{self.updated} <=", until)]

    def newest(self):
        return next(self.rows(f"max({self.updated})", []))[0]

    def ranges(self, since, until) -> list[_Range]:
        if until is None or until == since:
            return []
        low, high = next(self.rows(f"min({self.key}), max({self.key})", self.between(since, until)))
        if low is None:
            return []
        step = -(-(high - low + 1) // self.tasks)
        return [
            _Range(since, until, start, min(start + step, high + 1)) for start in range(low, high + 1, step)
        ]

    def read(self, part: _Range) -> Iterator[tuple]:
        inside = [(f"{self.key} >=", part.low), (f"{self.key} <", part.high)]
        yield from self.rows(", ".join(self.columns), [*self.between(part.since, part.until), *inside])


@dataclass
class _Range(InputPartition):
    """Changes after ``since`` up to ``until`` of the keys from ``low`` to below ``high``."""

    since: object
    until: object
    low: int
    high: int


class PolledStream(DataSourceStreamReader):
    def __init__(self, changes: Changes) -> None:
        self.changes = changes
        self.last = None

    def initialOffset(self) -> dict:
        return {"at": None}

    def latestOffset(self) -> dict:
        # A table that has become empty has no new change.
        newest = self.changes.newest()
        self.last = newest if newest is not None else self.last
        return {"at": self.last}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        # A task without rows, as a batch has at least one.
        return self.changes.ranges(start["at"], end["at"]) or [_Range(0, 0, 0, 0)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        return self.changes.read(partition) if partition.low < partition.high else iter([])


class PolledBatch(DataSourceReader):
    """The rows that are not deleted, as of now."""

    def __init__(self, changes: Changes) -> None:
        self.changes = changes

    def partitions(self) -> list[_Range]:
        return self.changes.ranges(None, self.changes.newest()) or [_Range(0, 0, 0, 0)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        return self.changes.read(partition) if partition.low < partition.high else iter([])


class PolledTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "polled_table"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PolledBatch(Changes(self.options, schema))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return PolledStream(Changes(self.options, schema))
