"""The polled source and the committed files, through Spark and step by step."""

from __future__ import annotations

import json
import sqlite3

import pyarrow as pa
import pytest

from conftest import rows
from tidecast.sinks.committed import CommittedFiles, CommittedWriter, published, read_published
from tidecast.sources.dimension import PolledDimension
from tidecast.sources.polled import Changes, PolledTable
from tidecast.streaming.runs import finish

GIFT = "id int, name string, points double, deleted int, updateTime long"


@pytest.fixture
def gifts(tmp_path):
    path = f"{tmp_path}/gifts.db"
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE gift (id INTEGER PRIMARY KEY, name TEXT, points REAL, deleted INTEGER, updateTime INTEGER)")
    return path


def change(path, *gift):
    with sqlite3.connect(path) as db:
        db.executemany("INSERT OR REPLACE INTO gift VALUES (?, ?, ?, ?, ?)", gift)


def options(path):
    return {"module": "sqlite3", "connect": json.dumps({"database": path}), "dbtable": "gift", "numPartitions": "3"}


def test_changes_come_through_and_restarts_go_on(spark, tmp_path, gifts):
    spark.dataSource.register(PolledTable)
    batches = []
    schema = spark.createDataFrame([], GIFT).schema
    fold = PolledDimension(spark, f"{tmp_path}/fold", schema)

    def poll():
        stream = spark.readStream.format("polled_table").schema(GIFT).options(**options(gifts)).load()

        def each(batch, number):
            batches.append(rows(batch.select("id", "deleted", "updateTime")))
            fold.poll(lambda: batch)

        finish(stream.writeStream.foreachBatch(each), f"{tmp_path}/checkpoint")

    change(gifts, *[(i, f"g{i}", i / 2, int(i % 5 == 0), 10 + i) for i in range(1, 21)])
    poll()
    assert [r[0] for r in batches[-1]] == [i for i in range(1, 21) if i % 5]
    change(gifts, (3, "g3", 9.0, 1, 40), (5, "g5", 5.0, 0, 41), (70, "new", 7.0, 0, 42))
    poll()
    # A new query: only what changed since, deleted or not.
    assert batches[-1] == [(3, 1, 40), (5, 0, 41), (70, 0, 42)]
    seen = len(batches)
    poll()
    assert all(b == [] for b in batches[seen:])
    live = [i for i in range(1, 21) if i % 5 and i != 3] + [5, 70]
    assert [r[0] for r in rows(fold.live(), "id")] == sorted(live)
    now = spark.read.format("polled_table").schema(GIFT).options(**options(gifts)).load()
    assert rows(now, "id", "name", "points") == rows(fold.live(), "id", "name", "points")


def test_empty_table_and_bad_names(spark, gifts):
    spark.dataSource.register(PolledTable)
    now = spark.read.format("polled_table").schema(GIFT).options(**options(gifts)).load()
    assert now.count() == 0
    schema = spark.createDataFrame([], GIFT).schema
    with pytest.raises(ValueError, match="no name"):
        Changes({**options(gifts), "dbtable": "gift; DROP TABLE gift"}, schema)
    changes = Changes(options(gifts), schema)
    change(gifts, *[(i, "g", 1.0, 0, 5) for i in (1, 2, 1_000_000_000)])
    parts = changes.ranges(None, 5)
    assert len(parts) == 3 and sum(len(list(changes.read(p))) for p in parts) == 3


ROWS = "id long, value string"


def test_stream_of_committed_files(spark, tmp_path):
    spark.dataSource.register(CommittedFiles)
    out, schema = f"{tmp_path}/out", spark.createDataFrame([], ROWS).schema
    for n in range(3):
        data = spark.range(100 * n, 100 * n + 100).selectExpr("id", "concat('v', id) AS value")
        data.repartition(3).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        writer = stream.writeStream.format("committed_files").option("path", out).option("rowsPerFile", "20")
        finish(writer, f"{tmp_path}/checkpoint")
        if n == 1:
            # The commit is lost: Spark runs the batch again under its number.
            for name in ("1", ".1.crc"):
                (tmp_path / "checkpoint/commits" / name).unlink(missing_ok=True)
    got = read_published(spark, out, schema)
    assert rows(got) == [(i, f"v{i}") for i in range(300)]
    assert [b["rows"] for _, b in sorted(published(out).items())] == [100, 100, 100]


def _stage(writer, *ids):
    batch = pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "value": pa.array([str(i) for i in ids])})
    return writer.write(iter([batch]))


def test_retries_aborts_and_replays_leave_the_same_rows(spark, tmp_path):
    out, schema = f"{tmp_path}/out", spark.createDataFrame([], ROWS).schema
    writer = CommittedWriter(out, 1000)
    assert published(out) == {} and read_published(spark, out, schema).count() == 0
    first, lost, second = _stage(writer, 1, 2), _stage(writer, 1, 2), _stage(writer, 3)
    assert len(lost.files) == 1
    writer.commit([first, None, second], 0)  # one task's first try is not among the messages
    writer.abort([_stage(writer, 9)], 1)
    writer.commit([_stage(writer, 4)], 1)
    writer.commit([_stage(writer, 3), _stage(writer, 1, 2)], 0)  # the batch again
    writer.commit([writer.write(iter([]))], 2)
    assert rows(read_published(spark, out, schema), "id") == [(1,), (2,), (3,), (4,)]
    kept = {p.name for p in (tmp_path / "out/data").iterdir()}
    assert kept - {f for b in published(out).values() for f in b["files"]} == set(lost.files)
