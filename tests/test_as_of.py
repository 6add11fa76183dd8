"""Versions in force at a row's time, against a search through all versions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidecast.operators.gifts import gift_points_as_of
from tidecast.plans.as_of import as_of_join, validity
from tidecast.streaming import as_of
from tidecast.streaming.runs import run_batches

ROWS = "id long, k int, at long, note string"
VERSIONS = "k int, since long, value string, nth int"


def sample(seed: int, n: int = 400, hot: float = 0.5):
    """Ties of time, a hot key, nulls everywhere, keys without versions."""
    rng = random.Random(seed)

    def key():
        return 1 if rng.random() < hot else rng.choice([2, 3, 4, None])

    rows = [(i, key(), rng.choice([None, *range(60)]), rng.choice([None, "x"])) for i in range(n)]
    versions = [
        (rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, *range(10, 50)]), rng.choice([None, "a", "b", "c"]), i)
        for i in range(n // 4)
    ]
    return rows, versions


def slow(rows, versions):
    out = []
    for i, k, at, note in rows:
        seen = [v for v in versions if v[0] == k and None not in (k, at, v[1]) and v[1] <= at]
        best = max(seen, key=lambda v: (v[1], v[3]), default=(None,) * 4)
        out.append((i, k, at, note, best[2], best[1]))
    return sorted(out)


@pytest.mark.parametrize("rows_per_chunk", [None, 20, 90])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_search(spark, seed, rows_per_chunk):
    rows, versions = sample(seed)
    got = as_of_join(
        spark.createDataFrame(rows, ROWS).repartition(4), spark.createDataFrame(versions, VERSIONS),
        ["k"], "at", "since", ["value"], ["nth"], rows_per_chunk,
    )
    assert got.columns == ["id", "k", "at", "note", "value", "since"]
    assert sorted(map(tuple, got.collect())) == slow(rows, versions)


def test_empty_sides_and_clashes(spark):
    rows, versions = sample(3, 40)
    r, v = spark.createDataFrame(rows, ROWS), spark.createDataFrame(versions, VERSIONS)
    assert as_of_join(r.limit(0), v, ["k"], "at", "since", ["value"]).count() == 0
    bare = as_of_join(r, v.limit(0), ["k"], "at", "since", ["value"])
    assert bare.where("value IS NULL").count() == 40
    with pytest.raises(ValueError, match="value"):
        as_of_join(r.withColumn("value", F.lit(1)), v, ["k"], "at", "since", ["value"])


def test_a_hot_key_is_cut(spark):
    """No (key, chunk) group is much larger than asked for, whatever the keys look like."""
    rows = spark.range(40_000).select(
        "id", F.lit(1).alias("k"), (F.col("id") * 7919 % 40_000).alias("at"), F.lit("x").alias("note")
    )
    versions = spark.range(400).select(
        F.lit(1).alias("k"), (F.col("id") * 100).alias("since"), F.col("id").cast("string").alias("value")
    )
    got = as_of_join(rows, versions, ["k"], "at", "since", ["value"], rows_per_chunk=1000)
    assert got.where("value = cast(floor(at / 100) as string) AND since = floor(at / 100) * 100").count() == 40_000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_chunk" in plan and "Join" not in plan


def test_validity(spark):
    versions = spark.createDataFrame([(1, 5, "a", 0), (1, 9, "b", 1), (1, 9, "c", 2), (2, 1, "d", 3)], VERSIONS)
    got = validity(versions, ["k"], "since", tie=["nth"])
    assert sorted(map(tuple, got.collect())) == [(1, 5, "a", 0, 9), (1, 9, "c", 2, None), (2, 1, "d", 3, None)]


CHANGES = "id int, name string, points double, deleted int, updateTime long"


def test_deleted_gifts_and_returning_ones(spark):
    changes = spark.createDataFrame(
        [(1, "rose", 5.0, 0, 10), (1, "rose", 5.0, 1, 20), (1, "tulip", 7.0, 0, 30)], CHANGES
    )
    rewards = spark.createDataFrame([(t, 1, t) for t in (9, 10, 19, 20, 29, 30)] + [(0, 2, 50)], "id int, gift_id int, timestamp long")
    got = gift_points_as_of(rewards, changes).select("id", "gift_name", "points").collect()
    assert {r["id"]: (r["gift_name"], r["points"]) for r in got} == {
        9: ("1", None), 10: ("rose", 5.0), 19: ("rose", 5.0), 20: ("1", None), 29: ("1", None),
        30: ("tulip", 7.0), 0: ("2", None),
    }


def test_stream_carries_versions(spark, tmp_path):
    """Six batches: rewards before and after changes, late by less and by more than is kept."""
    parts = [
        ([(1, 1, 12)], [(1, "a", 1.0, 0, 10), (2, "z", 9.0, 0, 5)]),
        ([(2, 1, 25), (3, 1, 15)], [(1, "b", 2.0, 0, 20)]),
        ([(4, 1, 26), (5, 1, 19), (6, 2, 30)], [(1, "b", 2.0, 1, 26)]),
        ([(7, 1, 27)], []),
        ([(8, 1, 100), (9, 1, 21), (10, 2, 101)], [(1, "c", 3.0, 0, 99)]),
        ([(11, 1, 22), (12, 1, 60), (13, 1, 99)], []),
    ]
    reward = "id int, gift_id int, timestamp long"
    path, want = f"{tmp_path}/in", {}
    every = [c for _, changes in parts for c in changes]
    for rewards, changes in parts:
        df = as_of.tagged(spark.createDataFrame(rewards, reward), spark.createDataFrame(changes, CHANGES))
        df.coalesce(1).write.mode("append").parquet(path)
        for i, gift, at in rewards:
            seen = [c for c in every if c[0] == gift and c[4] <= at]
            last = max(seen, key=lambda c: c[4], default=None)
            want[i] = (str(gift), None) if last is None or last[3] else last[1:3]
    # Its version was replaced 73 before the newest change of the earlier batches.
    want[11] = ("1", None)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = run_batches(
        stream, "as-of-test",
        lambda state, write: as_of.gift_points_batches(
            state, write, df.schema, ("id", "gift_id", "timestamp"), keep=50
        ),
        "id int, gift_id int, timestamp long, gift_name string, points double",
    )
    assert {r["id"]: (r["gift_name"], r["points"]) for r in got.collect()} == want
