"""Writers that may run twice, and what readers see."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows
from tidecast.operators.audience import audience_snapshot, visit_detail
from tidecast.sinks import tables

SCHEMA = (
    "id string, anchor_id string, deviceId string, eventId string, osName string,"
    " province string, releaseChannel string, deviceType string, timestamp bigint,"
    " isNew int, entered int"
)


def events(spark, *items):
    data = [
        (i, a, "d" + i, "liveEnter" if e else "liveLeave", "os", p, "ch", "ty", t, 0, e)
        for i, a, p, t, e in items
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_replayed_batch_leaves_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write = tables.table_writer(path, partition_by=("p",))
    one = spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string")
    two = spark.createDataFrame([(3, "x")], "v int, p string")
    for batch, number in ((one, 0), (two, 1), (two, 1), (one, 0)):
        write(batch, number)
    got = tables.read_table(spark, path, one.schema)
    assert rows(got, "batch", "v", "p") == [(0, 1, "x"), (0, 2, "y"), (1, 3, "x")]


def test_user_event_columns(spark):
    df = events(spark, ("1", "a", "p", 3_600_000, 1)).withColumns(
        {"date": F.lit("19700101"), "hour": F.lit("01")}
    )
    got = tables.user_event_rows(df, F.lit(77))
    assert tuple(got.first()) == (
        "1", "d1", "liveEnter", 0, "os", "p", "ch", "ty", 3_600_000, "19700101", "01", 77,
    )
    now = tables.user_event_rows(df).first()["processTime"]
    assert now > 1_600_000_000


def test_detail_table_keeps_the_newest_row(spark, tmp_path):
    path = str(tmp_path / "t")
    old = visit_detail(events(spark, ("1", "a", "old", 0, 1), ("2", "a", "p", 0, 0)))
    new = visit_detail(events(spark, ("1", "a", "new", 0, 1)))
    shape = lambda stamp: lambda df: tables.anchor_detail_rows(
        df, F.timestamp_seconds(F.lit(stamp))
    )
    parts = ("date", "hour")
    tables.table_writer(path, shape(10), parts)(old, 0)
    tables.table_writer(path, shape(20), parts)(new, 1)
    schema = shape(0)(old).schema
    got = tables.latest_details(tables.read_table(spark, path, schema))
    assert rows(got, "id", "province", "hour") == [("1", "new", "00"), ("2", "p", "00")]


def test_snapshot_last_write_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    day = 86_400_000
    first = events(spark, ("1", "a", None, 0, 1), ("2", "a", None, 11_000, 0))
    later = events(spark, ("3", "a", None, 12_000, 1), ("4", "a", None, day, 1))
    write = tables.table_writer(path)
    for number, df in enumerate((first, first.unionByName(later))):
        write(tables.snapshot_pairs(audience_snapshot(df)), number)
    schema = tables.snapshot_pairs(audience_snapshot(first)).schema
    got = tables.latest_snapshot(tables.read_table(spark, path, schema))
    assert rows(got) == [("a_19700101", "2,2,1"), ("a_19700102", "3,3,2")]


def test_multi_writer_computes_the_batch_once(spark, tmp_path):
    ran = spark.sparkContext.accumulator(0)

    def touch(it):
        for pdf in it:
            ran.add(len(pdf))
            yield pdf

    batch = spark.range(10).mapInPandas(touch, "id bigint")
    out = {}
    write = tables.multi_writer(
        (lambda df: df.where("id < 3"), lambda df, n: out.update(small=df.count())),
        (lambda df: df.where("id >= 3"), lambda df, n: out.update(large=df.count())),
    )
    write(batch, 0)
    assert out == {"small": 3, "large": 7}
    assert ran.value == 10


def test_jdbc_writer_options(spark):
    calls = {}

    class Writer:
        def format(self, name):
            calls["format"] = name
            return self

        def options(self, **kw):
            calls.update(kw)
            return self

        def option(self, name, value):
            calls[name] = value
            return self

        def mode(self, name):
            calls["mode"] = name
            return self

        def save(self):
            calls["saved"] = True

    class Rows:
        write = Writer()

    tables.jdbc_writer({"url": "jdbc:x"}, "tb_test", rows_per_insert=2)(Rows(), 0)
    assert calls == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "tb_test", "batchsize": 2,
        "mode": "append", "saved": True,
    }
