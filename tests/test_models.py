"""Batch operators against step-by-step models, whole and cut into chunks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from models import (
    VISIT_SCHEMA,
    audience as audience_model,
    count_first_seen as count_first_seen_model,
    first_seen,
    late_ids,
    popular_ids,
    top3,
    visits,
)
from tidecast.operators import orders, products, users
from tidecast.operators.audience import audience, audience_snapshot
from tidecast.operators.popularity import popular_entries, popularity
from tidecast.operators.totals import running_sum

CHUNKS = [None, 40]


@pytest.fixture(scope="module", params=[1, 2])
def sample(request, spark):
    events = visits(request.param)
    return events, spark.createDataFrame(events, VISIT_SCHEMA).cache()


@pytest.mark.parametrize("rows_per_chunk", CHUNKS)
@pytest.mark.parametrize("floor", [True, False])
def test_audience(sample, floor, rows_per_chunk):
    events, df = sample
    got = audience(df, floor, rows_per_chunk=rows_per_chunk)
    assert rows(got) == audience_model(events, floor)


@pytest.mark.parametrize("floor", [True, False])
def test_audience_final(sample, floor):
    events, df = sample
    last = {}
    for r in sorted(audience_model(events, floor), key=lambda r: (r[1], r[0])):
        last[r[2]] = r[2:]
    got = audience(df, floor, mode="final")
    assert rows(got, "anchor_id", "uv", "pv", "online") == sorted(last.values())


@pytest.mark.parametrize("rows_per_chunk", CHUNKS)
@pytest.mark.parametrize("floor", [True, False])
def test_audience_snapshot(sample, floor, rows_per_chunk):
    events, df = sample
    last = {}
    for r in sorted(audience_model(events, floor), key=lambda r: (r[1], r[0])):
        last[(r[2], r[1] // 10_000 * 10_000)] = r[3:]
    want = sorted((f"{a}_19700101", b, *v) for (a, b), v in last.items())
    got = audience_snapshot(df, floor_at_zero=floor, rows_per_chunk=rows_per_chunk)
    assert rows(got, "anchor_date", "bucket_start", "uv", "pv", "online") == want


@pytest.mark.parametrize("rows_per_chunk", [None, 300, 40, 7])
def test_popularity(sample, rows_per_chunk):
    events, df = sample
    got = popular_entries(df, 3000, 9000, rows_per_chunk)
    assert [r[0] for r in rows(got, "id")] == popular_ids(events, 3000, 9000)


def test_popularity_limits(spark):
    minute = 60_000
    moves = [
        ("stays", 0, 1), ("stays", minute, 0),
        ("short", 0, 1), ("short", minute - 1, 0),
        ("back", 0, 0), ("back", 30 * minute, 1),
        ("later", 0, 0), ("later", 30 * minute + 1, 1),
        ("lone", 5, 0),
        ("open", 7, 1),
    ]
    data = [(i, "a", d, t, e) for i, (d, t, e) in enumerate(moves)]
    df = spark.createDataFrame(data, VISIT_SCHEMA)
    assert [r[0] for r in rows(popular_entries(df), "deviceId")] == [
        "later", "open", "stays",
    ]
    assert rows(popularity(df)) == [("a", 3)]


@pytest.mark.parametrize("scope", [("anchor_id",), ()])
def test_first_seen(sample, scope):
    events, df = sample
    got = users.flag_first_seen(df, "deviceId", scope)
    assert dict(rows(got, "id", "isN")) == first_seen(events, scope)
    assert sum(first_seen(events, scope).values()) > 20


@pytest.mark.parametrize("rows_per_chunk", [None, 5])
def test_count_first_seen(sample, rows_per_chunk):
    events, df = sample
    got = users.count_first_seen(df, key="anchor_id", rows_per_chunk=rows_per_chunk)
    want = count_first_seen_model(events, "anchor_id")
    assert rows(got, "id", "isN", "perCnt") == want


@pytest.mark.parametrize("rows_per_chunk", CHUNKS)
def test_running_counts_with_null_key(spark, rows_per_chunk):
    rng = random.Random(5)
    data = [
        (i, rng.choice([None, None, "p", "q"]), rng.randrange(50), rng.randrange(9))
        for i in range(800)
    ]
    df = spark.createDataFrame(
        data, "id bigint, province string, timestamp bigint, quantity bigint"
    )
    counts, sums, want_counts, want_sums = {}, {}, [], []
    for i, province, t, q in sorted(data, key=lambda r: (r[2], r[0])):
        counts[province] = counts.get(province, 0) + 1
        sums[province] = sums.get(province, 0) + q
        want_counts.append((i, counts[province]))
        want_sums.append((i, sums[province]))
    got = users.count_users(df, ["province"], "running", rows_per_chunk=rows_per_chunk)
    assert rows(got, "id", "users") == sorted(want_counts)
    got = running_sum(df, ["province"], rows_per_chunk=rows_per_chunk)
    assert rows(got, "id", "total") == sorted(want_sums)


@pytest.mark.parametrize("rows_per_chunk", CHUNKS)
def test_pv_uv_running(sample, rows_per_chunk):
    events, df = sample
    seen, pv, want = {}, {}, []
    for e in sorted(events, key=lambda e: (e["timestamp"], e["id"])):
        key = (e["anchor_id"], e["entered"])
        seen.setdefault(key, set()).add(e["deviceId"])
        pv[key] = pv.get(key, 0) + 1
        want.append((e["id"], len(seen[key]), pv[key]))
    got = users.pv_uv(
        df, ["anchor_id", "entered"], "deviceId", "running",
        rows_per_chunk=rows_per_chunk,
    )
    assert rows(got, "id", "uv", "pv") == sorted(want)


def _shop(seed):
    rng = random.Random(seed)
    return [
        {
            "id": i,
            "timestamp": rng.randrange(0, 3_600_000),
            "eventId": rng.choice(["productView", "productOrder"]),
            "categoryId": rng.choice("xy"),
            "productId": f"p{rng.randrange(8)}",
        }
        for i in range(700)
    ]


@pytest.mark.parametrize("slide", [60_000, 90_000])
def test_top3_with_ties(spark, slide):
    events = _shop(3)
    df = spark.createDataFrame(
        events,
        "id bigint, timestamp bigint, eventId string, categoryId string, productId string",
    )
    got = products.top_products(df, 600_000, slide)
    columns = "categoryId eventId windowStart rank productId count".split()
    assert rows(got, *columns) == top3(events, 600_000, slide)
    lists = products.top_lists(got)
    assert lists.where(F.size("items") > 3).count() == 0
    assert lists.select(F.sum(F.size("items"))).first()[0] == got.count()


@pytest.mark.parametrize("rows_per_chunk", [None, 30])
def test_late_rows(spark, rows_per_chunk):
    rng = random.Random(9)
    events = [
        {"id": i, "timestamp": max(0, i * 300 + rng.randrange(-9000, 9000))}
        for i in range(600)
    ]
    df = spark.createDataFrame(events, "id bigint, timestamp bigint")
    on_time, late = orders.split_late(df, rows_per_chunk=rows_per_chunk)
    want = late_ids(events, 5000, 2000)
    assert [r[0] for r in rows(late, "id")] == want
    assert 20 < len(want) < 500
    assert on_time.count() + late.count() == len(events)


def _orders(spark):
    rng = random.Random(11)
    details = [(i, rng.randrange(40), rng.randrange(0, 60_000)) for i in range(500)]
    mains = [(rng.randrange(45), rng.randrange(0, 60_000), float(i)) for i in range(120)]
    table = [(i, 1000.0 + i, 1, i, f"p{i}") for i in range(20)]
    d = spark.createDataFrame(details, "id bigint, order_id bigint, update_ms bigint")
    m = spark.createDataFrame(
        mains, "oid bigint, main_update_ms bigint, total_money double"
    ).withColumns(
        {
            "status": F.lit(0),
            "uid": F.lit(0).cast("bigint"),
            "province": F.lit("m"),
        }
    )
    t = spark.createDataFrame(
        table, "oid bigint, total_money double, status int, uid bigint, province string"
    )
    return details, mains, table, d, m, t


def test_window_join_keeps_every_pair(spark):
    details, mains, _, d, m, _ = _orders(spark)
    want = []
    for i, order, t in details:
        pairs = [x for x in mains if x[0] == order and x[1] // 5000 == t // 5000]
        want += [(i, x[2]) for x in pairs] or [(i, None)]
    got = orders.windowed_left_join(d, m, "order_id", "oid", right_ts="main_update_ms")
    key = lambda r: tuple((v is not None, v) for v in r)
    assert rows(got, "id", "total_money") == sorted(want, key=key)
    assert len(want) > len(details)


@pytest.mark.parametrize("rows_per_chunk", [None, 60])
def test_match_orders(spark, rows_per_chunk):
    details, mains, table, d, m, t = _orders(spark)
    late = set(
        late_ids([{"id": i, "timestamp": ts} for i, _, ts in details], 5000, 2000)
    )
    known = {x[0]: x for x in table}
    want = []
    for i, order, ts in details:
        pairs = [x for x in mains if x[0] == order and x[1] // 5000 == ts // 5000]
        if i in late:
            pairs = []
        want += [(i, "joined", x[2]) for x in pairs]
        if not pairs and order in known:
            want.append((i, "lookup", known[order][1]))
        elif not pairs:
            want.append((i, "none", None))
    got = orders.match_orders(d, m, t, ["id"], rows_per_chunk=rows_per_chunk)
    key = lambda r: tuple((v is not None, v) for v in r)
    assert rows(got, "id", "main_source", "total_money") == sorted(want, key=key)
    assert {"joined", "lookup", "none"} == {w[1] for w in want} and late
