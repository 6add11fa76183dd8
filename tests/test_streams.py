"""Streams over several files give what the batch operators give."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from models import (
    CROWDED,
    VISIT_SCHEMA,
    audience as audience_model,
    first_seen,
    in_order,
    popular_ids,
    visits,
)
from tidecast.operators import audience, orders, products, users
from tidecast.sinks import tables
from tidecast.sources.dimension import with_fresh_dimension
from tidecast.streaming import processors
from tidecast.streaming.late import late_splitter, with_on_time_keys
from tidecast.streaming.runs import append_to_table, batches_to_table, finish

FILES = 4


def write_files(df, path, order, files=FILES):
    """Separate writes, so that the files are read in the order of their rows."""
    data = sorted(df.collect(), key=lambda r: tuple(r[c] for c in order))
    size = -(-len(data) // files)
    for i in range(0, len(data), size):
        part = df.sparkSession.createDataFrame(data[i : i + size], df.schema)
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return path


def stream(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    events = [e for e in visits(21, n=800) if e["timestamp"] != CROWDED]
    df = spark.createDataFrame(events, VISIT_SCHEMA)
    path = str(tmp_path_factory.mktemp("visits") / "rows")
    write_files(df, path, ("timestamp", "id"))
    return events, df, path


def test_audience(spark, sample):
    events, df, path = sample
    for floor in (True, False):
        visits_stream = stream(spark, path, df.schema)
        got = append_to_table(
            processors.audience_stream(visits_stream, floor, ttl_hours=None), "t"
        )
        columns = "id timestamp anchor_id uv pv online".split()
        assert rows(got, *columns) == audience_model(events, floor)


def test_first_seen(spark, sample):
    events, df, path = sample
    got = append_to_table(
        processors.flag_first_seen_stream(
            stream(spark, path, df.schema), "deviceId", ("anchor_id",)
        ),
        "t",
    )
    assert dict(rows(got, "id", "isN")) == first_seen(events, ("anchor_id",))


def test_count_first_seen(spark, sample):
    _, df, path = sample
    got = append_to_table(
        processors.count_first_seen_stream(
            stream(spark, path, df.schema), "deviceId", "anchor_id"
        ),
        "t",
    )
    want = users.count_first_seen(df, "deviceId", "anchor_id")
    assert rows(got, "id", "isN", "perCnt") == rows(want, "id", "isN", "perCnt")


def test_running_sum(spark, sample):
    _, df, path = sample
    shaped = lambda d: d.select(
        F.col("anchor_id").alias("category"), F.col("id").alias("quantity"),
        "timestamp", "id",
    )
    got = append_to_table(
        processors.running_sum_stream(shaped(stream(spark, path, df.schema))), "t"
    )
    totals, want = {}, []
    for r in in_order(shaped(df).collect()):
        totals[r["category"]] = totals.get(r["category"], 0) + r["quantity"]
        want.append((r["id"], totals[r["category"]]))
    assert rows(got, "id", "total") == sorted(want)


def test_popularity(spark, sample):
    """Enters still open at the end are decided by a late heartbeat."""
    events, df, path = sample
    stay, gap = 3000, 9000
    beat = spark.createDataFrame(
        [(10_000, "zz", "beat", 10_000_000, 0)], VISIT_SCHEMA
    )
    beats = str(path) + "-beats"
    write_files(df.unionByName(beat), beats, ("timestamp", "id"), 5)
    got = append_to_table(
        processors.popular_entries_stream(
            stream(spark, beats, df.schema), stay, gap, delay=1000
        ),
        "t",
    )
    assert [r[0] for r in rows(got, "id")] == popular_ids(events, stay, gap)


def test_snapshot_increments(spark, sample):
    _, df, path = sample
    flagged = processors.flag_first_enters_stream(stream(spark, path, df.schema))
    table = batches_to_table(
        flagged, "t", shape=lambda b: audience.snapshot_increments(b)
    )
    assert table.select("batch").distinct().count() >= FILES
    got = audience.snapshot_from_increments(table)
    columns = "anchor_date bucket_start uv pv online".split()
    assert rows(got, *columns) == rows(audience.audience_snapshot(df), *columns)


def test_counts_in_update_mode(spark, sample):
    _, df, path = sample
    counts = users.count_users(stream(spark, path, df.schema), ["anchor_id"])
    table = batches_to_table(counts, "t", output_mode="update")
    got = tables.latest_by(table, ["anchor_id"], ["batch"]).drop("batch")
    assert rows(got, "anchor_id", "users") == rows(
        users.count_users(df, ["anchor_id"]), "anchor_id", "users"
    )


def test_top_products(spark, sample):
    _, df, path = sample
    shaped = lambda d: d.select(
        "timestamp",
        F.lit("productView").alias("eventId"),
        F.col("anchor_id").alias("categoryId"),
        F.col("deviceId").alias("productId"),
    )
    counts = products.sliding_count(
        shaped(stream(spark, path, df.schema)), size=20_000, slide=5_000, delay=2_000
    )
    got = batches_to_table(counts, "t", shape=products.top_n)
    last = df.agg(F.max("timestamp")).first()[0]
    want = products.top_products(shaped(df), 20_000, 5_000).where(
        F.col("windowEnd") <= last - 2_000
    )
    columns = "categoryId eventId windowStart rank productId count".split()
    assert rows(got, *columns) == rows(want, *columns)
    assert want.count() > 50


def test_top_lists_of_timers(spark, tmp_path):
    """Lists of two, ties, windows that wait for their timer, and counts that come late."""
    size, parts = 10_000, [
        [("v", "c", p, t) for t in range(0, 30_000, 1000) for p in "xyz"[: 1 + t // 1000 % 3]],
        [("v", "c", "w", 25_000), ("v", "d", "x", 26_000), ("v", "c", "x", 47_000)],
        [("v", "c", "late", 3_000)] * 50 + [("v", "c", "x", 48_000)],
        [("v", "c", "x", 90_000)],
    ]
    schema = "eventId string, categoryId string, productId string, timestamp bigint"
    for part in parts:
        df = spark.createDataFrame(part, schema).coalesce(1)
        df.write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    source = stream(spark, f"{tmp_path}/in", df.schema)
    counts = products.sliding_count(source, size=size, slide=size, delay=2000)
    got = append_to_table(processors.top_products_stream(counts, n=2), "t")
    on_time = spark.createDataFrame([r for p in parts for r in p if r[2] != "late" and r[3] < 80_000], schema)
    want = products.top_products(on_time, size, size, n=2)
    columns = "eventId categoryId productId count windowStart windowEnd rank".split()
    assert rows(got, *columns) == rows(want, *columns) and got.count() > 6


def test_group_buy_closes_windows(spark, tmp_path):
    """Lone details appear once later rows on all inputs close their window."""
    flush = 600_000
    d = spark.createDataFrame(
        [
            (1000, "u1", "p1", "o1"), (1500, "u2", "p1", "o9"),
            (5001, "u3", "p9", "o2"), (5002, "u4", "p9", "o9"),
            (flush, "x", "x", "x"),
        ],
        "ts bigint, user_id string, group_id string, order_id string",
    )
    o = spark.createDataFrame(
        [(1001, "o1", "102", 200.0), (5002, "o2", "101", 3000.0), (flush, "y", "0", 0.0)],
        "ts bigint, order_id string, status string, amount double",
    )
    g = spark.createDataFrame(
        [(1000, "p1", "1", "c"), (flush, "z", "0", "c")],
        "ts bigint, group_id string, status string, category string",
    )
    inputs = []
    for name, df in (("d", d), ("o", o), ("g", g)):
        path = write_files(df, str(tmp_path / name), ("ts",), 2)
        inputs.append(stream(spark, path, df.schema, 10))
    got = append_to_table(
        orders.group_buy(*inputs).select("user_id", "order_amount", "group_category"), "t"
    )
    assert rows(got.where("user_id <> 'x'")) == [
        ("u1", 200.0, "c"), ("u2", None, "c"), ("u3", 3000.0, None), ("u4", None, None),
    ]


def late_writers(path):
    return (
        tables.table_writer(f"{path}/on-time"),
        tables.table_writer(f"{path}/late"),
    )


def test_late_splitter(spark, tmp_path):
    """A run per portion, the third one again as after a lost commit; repeated times, no time."""
    batches = [[1, 4, 20], [3, 12, 14, 40, None], [33, 37, 38, 60, 33], [61]]
    base, number, highest, want_late = str(tmp_path), 0, None, []
    schema = "id bigint, timestamp bigint"
    for n, seconds in enumerate(batches):
        times = [None if s is None else s * 1000 for s in seconds]
        known = [t for t in times if t is not None]
        if highest is not None:
            want_late += [t for t in known if t // 5000 * 5000 + 5000 <= highest - 2000]
        batch = spark.createDataFrame([(number + i, t) for i, t in enumerate(times)], schema)
        number += len(times)
        batch.coalesce(1).write.mode("append").parquet(f"{base}/in")
        rows_in = spark.readStream.schema(schema).parquet(f"{base}/in")
        stream_rows = with_on_time_keys(rows_in, size=5000, delay=2000)
        splitter = late_splitter(*late_writers(base))
        finish(stream_rows.writeStream.foreachBatch(splitter), f"{base}/checkpoint")
        highest = max(known + ([highest] if highest is not None else []))
        if n == 2:
            last = max(int(p.name) for p in (tmp_path / "checkpoint/commits").iterdir() if p.name.isdigit())
            for name in (f"{last}", f".{last}.crc"):
                (tmp_path / "checkpoint/commits" / name).unlink(missing_ok=True)
    late = tables.read_table(spark, f"{base}/late", batch.schema)
    on_time = tables.read_table(spark, f"{base}/on-time", batch.schema)
    assert [r[0] for r in rows(late, "timestamp")] == sorted(want_late)
    assert late.count() + on_time.count() == sum(map(len, batches))
    assert len(want_late) >= 3


def test_restart_goes_on_from_checkpoint(spark, tmp_path):
    path, base = str(tmp_path / "in"), str(tmp_path)
    schema = "deviceId string, timestamp bigint, id bigint"
    first = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 3)], schema)
    second = spark.createDataFrame([("a", 4, 4), ("c", 5, 5)], schema)
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(path)
        flagged = processors.flag_first_seen_stream(
            stream(spark, path, first.schema), "deviceId", ()
        )
        writer = flagged.writeStream.outputMode("append").format("parquet")
        finish(writer.option("path", f"{base}/out"), f"{base}/checkpoint")
    got = spark.read.parquet(f"{base}/out")
    assert rows(got, "id", "isN") == [(1, 1), (2, 0), (3, 1), (4, 0), (5, 1)]


def test_fresh_dimension(spark, tmp_path):
    """Each batch sees the table as it is when the batch runs."""
    path = str(tmp_path / "in")
    df = spark.createDataFrame([(1,), (2,)], "id bigint")
    write_files(df, path, ("id",), 2)
    reads, seen = [], {}

    def read():
        reads.append(len(reads))
        return spark.createDataFrame([(len(reads),)], "version int")

    def work(batch, dimension, batch_id):
        seen[batch_id] = (batch.count(), dimension.first()[0])

    writer = stream(spark, path, df.schema).writeStream.foreachBatch(
        with_fresh_dimension(read, work)
    )
    finish(writer, str(tmp_path / "checkpoint"))
    assert seen == {0: (1, 1), 1: (1, 2)}


def run_for(writer, checkpoint, done, seconds=90):
    """Run a stream that does not end by itself until ``done`` or time is up."""
    query = (
        writer.option("checkpointLocation", checkpoint)
        .trigger(processingTime="1 second")
        .start()
    )
    try:
        end = time.time() + seconds
        while time.time() < end and not done() and query.isActive:
            time.sleep(0.5)
        if query.exception():
            raise query.exception()
    finally:
        query.stop()


def test_state_with_lifetime(spark, sample, tmp_path):
    events, df, path = sample
    counted = processors.audience_stream(stream(spark, path, df.schema))
    base = str(tmp_path)
    done = lambda: read_all(spark, base, counted.schema).count() >= len(events)
    writer = counted.writeStream.foreachBatch(tables.table_writer(f"{base}/rows"))
    run_for(writer, f"{base}/checkpoint", done)
    got = read_all(spark, base, counted.schema)
    columns = "id timestamp anchor_id uv pv online".split()
    assert rows(got, *columns) == audience_model(events, True)


def read_all(spark, base, schema):
    import os

    if not os.path.exists(f"{base}/rows"):
        return spark.createDataFrame([], schema)
    return tables.read_table(spark, f"{base}/rows", schema)


def test_snapshot_timer(spark, sample, tmp_path):
    """The last timer of every room reports the totals of all its visits."""
    events, df, path = sample
    states = processors.audience_timer_stream(
        stream(spark, path, df.schema, 10), every="1 second", ttl_hours=6
    )
    base = str(tmp_path)
    last = {}
    for r in sorted(audience_model(events, False), key=lambda r: (r[1], r[0])):
        last[r[2]] = r[3:]

    def newest():
        table = read_all(spark, base, states.schema)
        if "batch" not in table.columns:
            return {}
        found = tables.latest_by(table, ["anchor_id"], ["bucket_start"])
        return {r["anchor_id"]: (r["uv"], r["pv"], r["online"]) for r in found.collect()}

    writer = states.writeStream.foreachBatch(tables.table_writer(f"{base}/rows"))
    run_for(writer, f"{base}/checkpoint", lambda: newest() == last)
    assert newest() == last
    table = read_all(spark, base, states.schema)
    assert table.where("bucket_start % 1000 <> 0").count() == 0
    assert table.where("anchor_date NOT LIKE concat(anchor_id, '_2%')").count() == 0


def test_console(spark, sample, tmp_path):
    _, df, path = sample
    query = tables.console(stream(spark, path, df.schema, 10))
    finish(query, str(tmp_path / "checkpoint"))


def test_late_enters_count_and_lifetimes_go_by_event_time(spark, tmp_path):
    """An enter hours behind the newest one is not lost; a device counts anew after the
    lifetime, and a room's counters start again after it."""
    hour = 3_600_000
    schema = "anchor_id string, deviceId string, timestamp bigint, id bigint, entered int"
    batches = [
        [("a", "x", 100 * hour, 1, 1)],
        [("a", "y", 101 * hour, 2, 1)],
        [("a", "z", 90 * hour, 3, 1), ("a", "x", 105 * hour, 4, 1)],
        [("a", "x", 112 * hour, 5, 1), ("a", "y", 112 * hour, 6, 0)],
    ]
    path = str(tmp_path / "in")
    for part in batches:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    got = append_to_table(
        processors.audience_stream(stream(spark, path, schema), False, ttl_hours=6), "t"
    )
    assert rows(got, "id", "uv", "pv", "online") == [
        (1, 1, 1, 1), (2, 2, 2, 2), (3, 3, 3, 3), (4, 3, 4, 4), (5, 1, 1, 1), (6, 1, 1, 0),
    ]


def test_table_of_another_checkpoint_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    write = tables.table_writer(path)
    write(df, 0)
    write(df, 1)
    with pytest.raises(ValueError):
        tables.table_writer(path)(df, 0)
    tables.table_writer(path)(df, 2)


def test_polls_read_only_changes(spark, tmp_path):
    from tidecast.sources.dimension import PolledDimension

    rows_ = [(1, "a", 0, 1), (2, "b", 0, 2), (1, "c", 0, 3), (2, "b", 1, 4), (3, "d", 0, 5)]
    table = spark.createDataFrame(rows_, "id int, name string, deleted int, updateTime bigint")
    want = {2: [(1, "a"), (2, "b")], 3: [(1, "c"), (2, "b")], 5: [(1, "c"), (3, "d")]}
    for upto, live in want.items():
        # A new object each time: the mark is in the table.
        polled = PolledDimension(spark, str(tmp_path / "p"), table.schema)
        assert rows(polled.poll(lambda: table.where(F.col("updateTime") <= upto)), "id", "name") == live
    seen = []
    polled.poll(lambda: seen.append(1) or table)
    assert rows(polled.live(), "id", "name") == want[5] and seen


def stored(spark, checkpoint, operator, name):
    found = spark.read.format("statestore").option("operatorId", operator)
    return found.option("stateVarName", name).load(checkpoint).count()


def test_visitors_share_states(spark, tmp_path):
    """Many visitors of few visits: states, and so calls, are bounded by the shares."""
    n, base = 3 * processors.SHARES, str(tmp_path)
    events = [(i, "a", f"d{i % n}", 1000 + i, 1) for i in range(n + 100)]
    df = spark.createDataFrame(events, VISIT_SCHEMA)
    path = write_files(df, f"{base}/in", ("timestamp", "id"), 2)
    entries = processors.popular_entries_stream(stream(spark, path, df.schema), 10, 5, delay=0)
    finish(entries.writeStream.format("parquet").option("path", f"{base}/entries"), f"{base}/c1")
    # The last ten enters stay within their minimum; the watermark is one behind the last.
    waits = {r["id"] for r in spark.read.schema(entries.schema).parquet(f"{base}/entries").collect()}
    assert waits >= set(range(n + 80)) and len(waits) < n + 100
    assert 0 < stored(spark, f"{base}/c1", 0, "visitors") <= processors.SHARES
    flagged = processors.flag_first_enters_stream(stream(spark, path, df.schema))
    finish(flagged.writeStream.format("parquet").option("path", f"{base}/flagged"), f"{base}/c2")
    got = spark.read.schema(flagged.schema).parquet(f"{base}/flagged")
    assert rows(got, "id", "isN") == [(i, int(i < n)) for i in range(n + 100)]
    assert 0 < stored(spark, f"{base}/c2", 0, "seen") <= processors.SHARES


def test_a_batch_is_computed_once(spark, tmp_path):
    """However often the shape reads it."""
    df = spark.createDataFrame([(i, "d") for i in range(40)], "id bigint, deviceId string")
    path = write_files(df, f"{tmp_path}/in", ("id",), 2)
    computed = spark.sparkContext.accumulator(0)

    def seen(value):
        computed.add(1)
        return value

    counted = stream(spark, path, df.schema).withColumn("id", F.udf(seen, "bigint")("id"))

    def shape(batch):
        return batch.unionByName(batch).join(batch.groupBy("deviceId").count(), "deviceId")

    table = batches_to_table(counted, "t", shape)
    # The empty frame that gives the schema has no rows to count.
    assert table.count() == 80 and computed.value == 40
