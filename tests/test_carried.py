"""Running totals over micro-batches, and first-seen flags without Python state."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from models import CROWDED, VISIT_SCHEMA, audience as audience_model, first_seen, visits
from test_streams import stream, write_files
from tidecast.operators import users
from tidecast.sinks import tables
from tidecast.streaming import carried
from tidecast.streaming.first_seen import flagged_batch, marked
from tidecast.streaming.runs import batches_to_table, run_batches

ENTERS = ("anchor_id", "entered")
COUNTED = "id bigint, timestamp bigint, anchor_id string, uv bigint, pv bigint, online bigint"


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    events = [e for e in visits(31, n=700) if e["timestamp"] != CROWDED]
    df = spark.createDataFrame(events, VISIT_SCHEMA)
    path = str(tmp_path_factory.mktemp("visits") / "rows")
    return events, df, write_files(df, path, ("timestamp", "id"))


@pytest.mark.parametrize("floor,rows_per_chunk", [(True, None), (True, 25), (False, 40)])
def test_audience(spark, sample, floor, rows_per_chunk):
    events, df, path = sample
    got = run_batches(
        marked(stream(spark, path, df.schema), "deviceId", ENTERS), "t",
        lambda state, write: carried.audience_batches(state, write, floor, rows_per_chunk), COUNTED,
    )
    assert rows(got, *"id timestamp anchor_id uv pv online".split()) == audience_model(events, floor)


def test_first_seen(spark, sample):
    events, df, path = sample
    got = batches_to_table(
        marked(stream(spark, path, df.schema), "deviceId", ("anchor_id",)), "t",
        shape=lambda batch: flagged_batch(batch, "deviceId", ("anchor_id",)),
    )
    assert dict(rows(got, "id", "isN")) == first_seen(events, ("anchor_id",))


def test_counts_of_new(spark, sample):
    _, df, path = sample
    got = run_batches(
        marked(stream(spark, path, df.schema), "deviceId", ()), "t",
        lambda state, write: carried.first_seen_count_batches(state, write, "deviceId", "anchor_id"),
        "id bigint, isN int, perCnt int",
    )
    want = users.count_first_seen(df, "deviceId", "anchor_id")
    assert rows(got, "id", "isN", "perCnt") == rows(want, "id", "isN", "perCnt")


def test_null_users_and_scopes_are_values(spark, tmp_path):
    data = [(i, i, random.Random(i).choice([None, "a"]), random.Random(i * 7).choice([None, "t"])) for i in range(60)]
    df = spark.createDataFrame(data, "timestamp bigint, id bigint, deviceId string, deviceType string")
    write_files(df, f"{tmp_path}/in", ("timestamp",))
    got = batches_to_table(marked(stream(spark, f"{tmp_path}/in", df.schema)), "t", shape=flagged_batch)
    seen, want = set(), {}
    for _, i, user, kind in data:
        want[i] = int((user, kind) not in seen)
        seen.add((user, kind))
    assert dict(rows(got, "id", "isN")) == want


def test_no_python_in_the_plan(spark, sample):
    _, df, path = sample
    plan = marked(stream(spark, path, df.schema), "deviceId", ("anchor_id",))._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "Arrow" not in plan
    batch = df.withColumn("deviceType", F.lit("t")).withColumn("_new_key", F.lit(False))
    plan = flagged_batch(batch)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_batch_again_gives_the_same_and_old_totals_go(spark, tmp_path):
    schema = "category string, quantity int, timestamp bigint, id bigint"
    each = carried.running_sum_batches(f"{tmp_path}/state", tables.table_writer(f"{tmp_path}/rows"))
    parts = [[("a", 1, 1, 1), (None, 5, 1, 2)], [("a", 2, 2, 3), ("b", 4, 2, 4)], [], [("b", 1, 3, 5), (None, 1, 9, 6)]]
    for n, part in enumerate(parts):
        batch = spark.createDataFrame(part, schema)
        each(batch, n)
        if n in (1, 3):
            each(batch, n)
    got = spark.read.parquet(f"{tmp_path}/rows")
    assert dict(rows(got, "id", "total")) == {1: 1, 2: 5, 3: 3, 4: 4, 5: 5, 6: 6}
    assert sorted(p.name for p in (tmp_path / "state/totals").iterdir() if p.is_dir()) == ["batch=2", "batch=3"]


def test_one_room_is_spread_over_tasks(spark, tmp_path):
    """All visits in one room: no task has over twice the median rows."""
    n, found = 40_000, []
    batch = spark.range(n).select(
        F.lit("room").alias("anchor_id"), (F.col("id") % 900).cast("string").alias("deviceId"),
        (F.col("id") * 7919 % 50_000).alias("timestamp"), "id", (F.col("id") % 3 != 0).cast("int").alias("entered"),
    )
    keys = batch.select("anchor_id", "entered", "deviceId").distinct().withColumn("_new_key", F.lit(True))
    batch = batch.withColumn("_new_key", F.lit(False)).unionByName(keys, allowMissingColumns=True)

    def write(counted, batch_id):
        per_task = counted.groupBy(F.spark_partition_id().alias("task")).count()
        found.append((sorted(r["count"] for r in per_task.collect()), counted.agg(F.max("pv")).first()[0]))

    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(before, ("false", "8")):
            spark.conf.set(k, v)
        each = carried.audience_batches(f"{tmp_path}/state", write, rows_per_chunk=100)
        each(batch, 0)
        each(batch.withColumn("_new_key", F.col("_new_key")), 1)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    enters = n - -(-n // 3)
    for (counts, pv), want in zip(found, (enters, 2 * enters)):
        assert sum(counts) == n and pv == want
        assert counts[-1] <= 2 * counts[len(counts) // 2]
