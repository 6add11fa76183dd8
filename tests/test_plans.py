"""Plans hold what the operators promise: pruning, early limits, no cross joins."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from conftest import rows
from models import VISIT_SCHEMA, visits
from tidecast.catalog import REGISTRY
from tidecast.operators import filters
from tidecast.operators.audience import audience
from tidecast.operators.orders import windowed_left_join
from tidecast.plans.chunks import CHUNK, split_chunks
from tidecast.sinks import tables

BATCH = sorted(
    n for n in REGISTRY if not n.startswith(("stream_", "sink_", "source_"))
)


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, data, name):
    text = plan(queries()[name](spark, data))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert bad not in text
    # Such a frame is computed anew for every row of the group.
    assert "unboundedfollowing" not in text


def test_scan_reads_only_what_is_needed(spark, data):
    text = plan(queries()["users_by_device_type"](spark, data))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,props:string>" in text


def test_event_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame(
        [("1", "liveEnter", {"anchor_id": "a"})],
        "id string, eventId string, properties map<string,string>",
    ).write.parquet(path)
    events = spark.read.parquet(path)
    assert "StringStartsWith(eventId,product)" in plan(filters.product_events(events))
    text = plan(filters.room_visits(events).select("id"))
    assert "In(eventId, [liveEnte" in text
    assert "EqualTo(eventId,appLaunch)" in plan(filters.app_launches(events))


@pytest.mark.parametrize("name", ["product_top3", "dimension_poll", "sort_desc_limit"])
def test_ranks_are_limited_before_the_shuffle(spark, data, name):
    text = plan(queries()[name](spark, data))
    before = text.index("Partial", text.index("WindowGroupLimit"))
    assert before > 0 and text.count("WindowGroupLimit") == 2


def test_latest_copy_is_limited_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS key", "id AS seq")
    assert "Partial" in plan(tables.latest_by(df, ["key"], ["seq"]))


def test_windows_count_panes_first(spark, data):
    text = plan(queries()["product_sliding_count"](spark, data))
    assert text.count("Exchange hashpartitioning") == 2


def test_chunks_are_even_when_one_key_and_one_instant_are_hot(spark):
    df = spark.range(30_000).select(
        "id",
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("t"),
    )
    chunked = split_chunks(df, ["t", "id"], 1000)
    sizes = [r["count"] for r in chunked.groupBy(CHUNK).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 3_500
    edges = chunked.groupBy(CHUNK).agg(
        F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi")
    ).orderBy(CHUNK).collect()
    for a, b in zip(edges, edges[1:]):
        assert tuple(a["hi"]) < tuple(b["lo"])


def test_chunks_follow_fractions_around_a_crowded_value(spark):
    df = spark.range(9_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 5.0)
        .when(F.col("id") % 3 == 1, 5.0 + F.col("id") / 9_000)
        .otherwise(F.col("id").cast("double"))
        .alias("t"),
    )
    chunked = split_chunks(df, ["t", "id"], 500)
    edges = chunked.groupBy(CHUNK).agg(
        F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi")
    ).orderBy(CHUNK).collect()
    assert len(edges) > 10
    for a, b in zip(edges, edges[1:]):
        assert tuple(a["hi"]) < tuple(b["lo"])


def test_chunks_need_a_number(spark):
    df = spark.createDataFrame([("a",)], "id string")
    with pytest.raises(ValueError):
        split_chunks(df, ["id"])


def test_chunked_audience_shuffles_the_visits_once(spark):
    df = spark.createDataFrame(visits(4), VISIT_SCHEMA)
    counted = audience(df, rows_per_chunk=100)
    counted.collect()
    assert "ReusedExchange" in plan(counted)


def test_hot_key_of_a_join_is_split(spark):
    details = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("order_id"),
        F.lit(0).cast("bigint").alias("update_ms"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    mains = spark.range(60_000).select(
        F.col("id").alias("oid"), F.lit(1).cast("bigint").alias("main_update_ms")
    )
    small = "200k"
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes=small,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes=small,
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    ):
        joined = windowed_left_join(
            details.repartition(8), mains, "order_id", "oid", right_ts="main_update_ms"
        )
        keys = [r["oid"] for r in joined.collect()]
        text = plan(joined)
    # Every third row, and the row whose own number is 7.
    assert keys.count(7) == 20_001 and len(keys) == 60_000
    assert "skew=true" in text


def test_large_region_tables_shuffle(spark, data):
    """Without broadcasts places are met by cell in shuffled joins, and stay right."""
    q = queries()
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        far = q["location_join"](spark, data)
        assert "Broadcast" not in plan(far) and "SortMergeJoin" in plan(far)
        found = rows(far, "id", "province", "city")
    assert found == rows(q["enrich_location"](spark, data), "id", "province", "city")


def test_no_join_input_meets_in_one_task(spark, data):
    for name in ("gift_points_join", "gift_points_by_anchor", "lookup_by_key", "location_join"):
        with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
            found = plan(queries()[name](spark, data))
        joins = [x for x in found.splitlines() if "SinglePartition" in x]
        assert not joins, (name, joins)


@pytest.mark.parametrize("instant", ["5", "null"])
def test_crowded_instants_are_cut_by_text_ids(spark, instant):
    df = spark.range(40_000).select(
        F.expr(f"CAST({instant} AS BIGINT)").alias("timestamp"),
        F.format_string("live-%d-%06d", F.col("id") % 3, F.col("id")).alias("id"),
    )
    cut = split_chunks(df, ["timestamp", "id"], 1000)
    sizes = cut.groupBy(CHUNK).agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    found = sizes.orderBy(CHUNK).collect()
    assert max(r["n"] for r in found) < 3000
    assert all(x["b"] < y["a"] for x, y in zip(found, found[1:]))
