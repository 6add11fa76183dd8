"""Membership in a filter of set size, and sketches of visitors."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidecast.operators import users
from tidecast.sinks import tables
from tidecast.streaming.bloom import Bloom, bloom_flag_batches, merged
from tidecast.streaming.runs import finish


def test_seen_users_are_held_and_the_error_is_as_computed(spark):
    bloom = Bloom(log_bits=17, hashes=4)
    devices = spark.range(40_000).select(F.concat(F.lit("d"), "id").alias("u"), "id")
    seen, new = devices.where("id < 20000"), devices.where("id >= 20000")
    words = merged(*[bloom.words(seen.where(f"id % 3 = {i}"), "u") for i in range(3)])
    assert rows(words) == rows(bloom.words(seen, "u")) and words.count() <= 2**11
    assert bloom.unseen(seen.select("u"), words, "u").count() == 0
    wrong = 20_000 - bloom.unseen(new.select("u"), words, "u").count()
    expected = (1 - 2.718281828 ** (-4 * 20_000 / 2**17)) ** 4
    assert 0.5 * expected < wrong / 20_000 < 1.5 * expected


def test_empty_filter_and_nulls(spark):
    bloom = Bloom(log_bits=10)
    some = spark.createDataFrame([("a", None), (None, None), ("a", "x")], "u string, scope string")
    none = bloom.words(some.limit(0), "u", "scope")
    assert bloom.unseen(some, none, "u", "scope").count() == 3
    assert bloom.unseen(some, bloom.words(some, "u", "scope"), "u", "scope").count() == 0


def test_flags_go_on_after_a_restart(spark, tmp_path):
    schema, base = "id long, timestamp long, deviceId string", str(tmp_path)
    parts = [["a", "b", "a"], ["b", "c", None], ["c", "a"], [None, "d", "d"]]
    seen, want, number = set(), {}, 0
    for part in parts:
        data = []
        for user in part:
            want[number] = int(user not in seen)
            seen.add(user)
            data.append((number, number, user))
            number += 1
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in")
        # A new query each time: the filter comes from what the last one left.
        each = bloom_flag_batches(f"{base}/state", tables.table_writer(f"{base}/rows"), bloom=Bloom(16))
        finish(stream.writeStream.foreachBatch(each), f"{base}/checkpoint")
    assert dict(rows(spark.read.parquet(f"{base}/rows"), "id", "isN")) == want


@pytest.mark.parametrize("visitors,error", [(1_500, 0.0), (60_000, 0.03)])
def test_sketches_add_up(spark, visitors, error):
    visits = spark.range(3 * visitors).select(
        F.lit("a").alias("activity"), F.lit("e").alias("event"), (F.col("id") % visitors).cast("string").alias("uid")
    )
    parts = users.visit_sketches(visits.limit(visitors)).unionByName(users.visit_sketches(visits))
    uv, pv = users.sketched_pv_uv(parts).select("uv", "pv").first()
    assert pv == 4 * visitors and abs(uv - visitors) <= error * visitors
