"""Parts, manifests and compaction of a detail table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidecast.sinks.manifest import Conflict, ManifestTable

SCHEMA = "id long, at long, value string"


@pytest.fixture
def table(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return ManifestTable(spark, f"{tmp_path}/t", schema, ["id"], ["at"], fan=3)


def batch(spark, number):
    """Ids that every batch writes again, ids of its own, and rows older than earlier ones."""
    rows = [(i, 100 - number if i == 3 else number, f"{number}") for i in range(5)]
    return spark.createDataFrame(rows + [(1000 + number, number, "own")], SCHEMA).repartition(3)


def want(numbers):
    out = {i: (max(numbers), str(max(numbers))) for i in range(5)}
    out[3] = (100 - min(numbers), str(min(numbers)))
    return out | {1000 + n: (n, "own") for n in numbers}


def got(df):
    rows = df.collect()
    assert len({r["id"] for r in rows}) == len(rows)
    return {r["id"]: (r["at"], r["value"]) for r in rows}


def test_rows_stay_and_parts_are_few(spark, table):
    for n in range(14):
        table.append(batch(spark, n), n)
        parts = table.parts()
        # Never more than fan - 1 parts on a level, and no batch twice.
        assert max(sum(p.level == k for p in parts) for k in range(4)) <= 2
        assert [p.first for p in parts] == sorted(p.first for p in parts)
        assert sum(p.last - p.first + 1 for p in parts) == n + 1
        if n in (0, 2, 7, 13):
            assert got(table.read()) == want(range(n + 1))
    assert len(table.parts()) <= 6


def test_readers_stay_on_their_version(spark, table):
    for n in range(2):
        table.append(batch(spark, n), n)
    before, version = table.read(), max(table.versions())
    table.append(batch(spark, 2), 2)  # merges the three
    assert [p.level for p in table.parts()] == [1]
    assert got(before) == got(table.read(version)) == want(range(2))
    assert table.vacuum(keep=1) == 3
    assert got(table.read()) == want(range(3))


def test_replays(spark, table):
    table.append(batch(spark, 0), 0)
    table.append(batch(spark, 0), 0)
    assert len(table.parts()) == 1 and got(table.read()) == want([0])
    for n in (1, 2):
        table.append(batch(spark, n), n)
    # The batch has been merged; its rows are there.
    version = max(table.versions())
    table.append(batch(spark, 1), 1)
    assert max(table.versions()) == version and got(table.read()) == want(range(3))


def test_one_of_two_writers_wins(spark, table):
    table.append(batch(spark, 0), 0)
    parts, version = table.parts(), max(table.versions())
    table.publish(parts, version + 1)
    with pytest.raises(Conflict):
        table.publish([], version + 1)
    assert table.parts() == parts
    names = [p.getPath().getName() for p in table._files().listStatus(table._file("manifests"))]
    assert sorted(n for n in names if not n.startswith(".")) == ["0", "1"]


def test_a_part_without_a_manifest_is_not_read(spark, table):
    table.append(batch(spark, 0), 0)
    table._written(batch(spark, 1).withColumn("batch", F.lit(1).cast("bigint")), 1, 1, 0)
    assert got(table.read()) == want([0])
    assert ManifestTable(spark, table.path + "-none", batch(spark, 0).schema, ["id"]).read().count() == 0


def test_merged_files_hold_neighbouring_keys(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = ManifestTable(spark, f"{tmp_path}/t", schema, ["id"], ["at"], fan=2, file_bytes=20_000)
    for n in range(2):
        rows = spark.range(5_000).select("id", F.lit(n).cast("long").alias("at"), F.uuid().alias("value"))
        table.append(rows.repartition(4), n)
    files = spark.read.parquet(
        f"{table.path}/parts/{table.parts()[0].name}"
    ).select(F.input_file_name().alias("f"), "id")
    spans = sorted((r["lo"], r["hi"]) for r in files.groupBy("f").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect())
    assert len(spans) > 3 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert table.read().count() == 5_000
