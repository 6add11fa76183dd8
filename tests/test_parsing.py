"""Records that are whole, damaged or oddly written."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import rows
from tidecast.operators import filters, gifts
from tidecast.operators.location import _laid_out, enrich_location, join_locations
from tidecast.schemas import EVENT, GIFT, ORDER_DETAIL, ORDER_MAIN
from tidecast.sources.dimension import changed_since, conform, latest_dimension
from tidecast.sources.json_records import checked_cdc, checked_events, counted, parse_cdc, parse_events
from tidecast.sources.records import kafka_options, record_values, with_record_id


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_events(spark):
    got = parse_events(
        texts(
            spark,
            '{"deviceId":"a","timestamp":1,"latitude":1.5,"isNew":1,"properties":{"k":69,"n":{"q":1}}}',
            '{"deviceId":"b","timestamp":"2","latitude":"","isNew":"null","extra":[1,2]}',
            "{deviceId:'c', timestamp: 3}",
            "{}",
            "{bad", "", "   ", None, "null", "[1]", '[{"deviceId":"x"}]', "7",
            '{"deviceId":"x"} tail', '{"timestamp":"soon"}', '{"properties":5}',
            '{"deviceId":"x"',
        )
    )
    assert got.schema.names == EVENT.names
    assert rows(got, "deviceId", "timestamp", "latitude", "isNew", "isN", "perCnt") == [
        (None, None, None, 0, 0, 0),
        ("a", 1, 1.5, 1, 0, 0),
        ("b", 2, None, 0, 0, 0),
        ("c", 3, None, 0, 0, 0),
    ]
    properties = got.where("deviceId = 'a'").first()["properties"]
    assert properties == {"k": "69", "n": '{"q":1}'}


def test_events_with_id(spark):
    raw = spark.createDataFrame(
        [
            ("t", 1, 5, b'{"id":"own","deviceId":"a"}'),
            ("t", 1, 6, b"{"),
            ("t", 2, 7, '{"deviceId":"手机"}'.encode()),
        ],
        "topic string, partition int, offset bigint, value binary",
    )
    got = parse_events(with_record_id(raw), id_column="id")
    assert got.schema.names == EVENT.names
    assert rows(got, "id", "deviceId") == [("t-1-5", "a"), ("t-2-7", "手机")]
    assert record_values(raw).count() == 3


def test_cdc(spark):
    raw = texts(
        spark,
        '{"type":"INSERT","data":[{"oid":"1","create_time":"2023-05-01 12:00:00",'
        '"total_money":"10.5","update_time":1682565505000},{"oid":2}]}',
        '{"type":"UPDATE","data":[{"oid":"4","status":"x"},{"oid":"5","status":""}]}',
        '{"type":"DELETE","data":[{"oid":3}]}',
        '{"type":"ALTER","data":[{"oid":9}]}',
        '{"type":"DELETE","data":null}', '{"type":"INSERT","data":[]}',
        '{"data":[{"oid":9}]}', "x", "", None,
    )
    got = parse_cdc(raw, ORDER_MAIN)
    assert got.schema.names == [*ORDER_MAIN.names, "type"]
    assert rows(got, "oid", "type") == [
        (1, "INSERT"), (2, "INSERT"), (3, "DELETE"), (5, "UPDATE"),
    ]
    first = got.where("oid = 1").first()
    assert first["total_money"] == 10.5
    made = got.where("oid = 1").selectExpr(
        "unix_millis(create_time)", "unix_millis(update_time)"
    ).first()
    noon = dt.datetime(2023, 5, 1, 12, tzinfo=dt.timezone.utc).timestamp() * 1000
    assert tuple(made) == (noon, 1682565505000)
    assert rows(parse_cdc(raw, ORDER_DETAIL, ops=("DELETE",)), "type") == [("DELETE",)]


def test_properties(spark):
    events = spark.createDataFrame(
        [
            ("1", "liveReward", {"anchor_id": "a", "gift_id": "7"}),
            ("2", "liveReward", {"anchor_id": "a", "gift_id": "seven"}),
            ("3", "liveReward", {"gift_id": "7"}),
            ("4", "liveEnter", {"anchor_id": "a"}),
            ("5", "liveEnter", {}),
            ("6", "productView", {"categoryId": "c", "productId": "p"}),
            ("7", "productView", {"categoryId": "c"}),
            ("8", None, None),
        ],
        "id string, eventId string, properties map<string,string>",
    )
    assert rows(gifts.reward_gifts(filters.rewards(events)), "id", "gift_id") == [("1", 7)]
    assert rows(filters.room_visits(events), "id", "entered") == [("4", 1)]
    assert rows(filters.product_events(events), "id") == [("6",)]
    assert rows(filters.filter_events(events, prefix="live"), "id") == [
        (str(i),) for i in range(1, 6)
    ]


def gift_changes(spark):
    return spark.createDataFrame(
        [
            (1, "rose", 1.0, 0, 10), (1, "rose", 2.0, 0, 20),
            (2, "car", 9.0, 0, 10), (2, "car", 9.0, 1, 20),
            (3, "cup", 5.0, 1, 10), (3, "cup", 6.0, 0, 20),
        ],
        "id int, name string, points double, deleted int, updateTime bigint",
    )


def test_table_conforms_to_schema(spark):
    raw = spark.createDataFrame(
        [("2023-05-01 00:00:00", 0, "1", "rose", 2)],
        "updateTime string, deleted bigint, id string, name string, points int",
    )
    got = conform(raw, GIFT)
    assert [f.dataType for f in got.schema] == [f.dataType for f in GIFT]
    assert got.first()["points"] == 2.0


def test_dimension(spark):
    changes = gift_changes(spark)
    assert rows(latest_dimension(changes), "id", "points") == [(1, 2.0), (3, 6.0)]
    assert changed_since(changes).count() == 4
    assert rows(changed_since(changes, 10), "id", "deleted") == [(1, 0), (2, 1), (3, 0)]


def test_gift_points(spark):
    rewards = spark.createDataFrame(
        [(1, "a", 1), (2, "a", 1), (3, "a", 2), (4, "b", 2), (5, "c", 3)],
        "id int, anchor_id string, gift_id int",
    )
    live = latest_dimension(gift_changes(spark))
    got = gifts.gift_points(rewards, live)
    assert rows(got, "id", "gift_name", "points") == [
        (1, "rose", 2.0), (2, "rose", 2.0), (3, "2", None), (4, "2", None),
        (5, "cup", 6.0),
    ]
    want = [("a", 4.0), ("b", None), ("c", 6.0)]
    assert rows(gifts.points_by(got)) == want
    assert rows(gifts.gift_points_by_anchor(rewards, live)) == want


def test_location(spark):
    regions = spark.createDataFrame(
        [
            (0.0, 25.0, 0.0, 25.0, "west", "w"),
            (25.0, 50.0, 0.0, 25.0, "east", "e"),
            (-30.0, -10.0, -30.0, -10.0, "south", "s"),
            (20.0, 30.0, 0.0, 5.0, "border", "b"),
            (5.0, 5.0, 0.0, 9.0, "empty", "x"),
        ],
        "lon_min double, lon_max double, lat_min double, lat_max double,"
        " province string, city string",
    )
    events = spark.createDataFrame(
        [
            (1, 0.0, 0.0), (2, 24.999, 10.0), (3, 25.0, 10.0), (4, 50.0, 10.0),
            (5, -10.0, -10.0), (6, -10.001, -29.0), (7, None, 3.0), (8, 22.0, 1.0),
        ],
        "id int, longitude double, latitude double",
    )
    want = [
        (1, "west"), (2, "west"), (3, "east"), (4, None),
        (5, None), (6, "south"), (7, None), (8, "border"),
    ]
    for place in (enrich_location, join_locations):
        got = place(events, regions)
        assert got.columns == [*events.columns, "province", "city"]
        assert rows(got, "id", "province") == want
        assert place(events.limit(0), regions).count() == 0
        assert place(events, regions.limit(0)).where("province IS NULL").count() == 8


BOX = "lon_min double, lon_max double, lat_min double, lat_max double, province string, city string"


def test_boxes_of_very_different_sizes(spark):
    """From a whole world to a house, overlapping, on cell borders, and beyond the map."""
    rng = random.Random(11)
    boxes = [(-180.0, 180.0, -90.0, 90.0, "z", "world"), (-400.0, 400.0, -400.0, 400.0, "zz", "more")]
    for i in range(300):
        size = 10 ** rng.uniform(-7, 2)
        lon, lat = rng.uniform(-180, 180), rng.uniform(-90, 90)
        if i % 5 == 0:
            lon, lat, size = round(lon / 45) * 45.0, round(lat / 22.5) * 22.5, 360 / 2 ** rng.randint(1, 20)
        boxes.append((lon, lon + size, lat, lat + size * rng.uniform(0.1, 1), rng.choice("abcdef"), f"c{i}"))
    points = [(rng.uniform(-200, 200), rng.uniform(-100, 100)) for _ in range(200)]
    for b in boxes:
        points += [(b[0], b[2]), (b[1], b[3]), ((b[0] + b[1]) / 2, (b[2] + b[3]) / 2)]
    events = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, longitude double, latitude double")
    want = []
    for i, (x, y) in enumerate(points):
        held = [b[4:] for b in boxes if b[0] <= x < b[1] and b[2] <= y < b[3]]
        want.append((i, *min(held, default=(None, None))))
    regions = spark.createDataFrame(boxes, BOX)
    for place in (enrich_location, join_locations):
        assert rows(place(events, regions), "id", "province", "city") == want


def test_cells_hold_few_boxes(spark):
    """A hundred thousand cities and their country: a handful of cells a box, of boxes a cell."""
    cities = spark.range(100_000).select(
        (F.col("id") % 400 * 0.1).alias("lon_min"), (F.floor(F.col("id") / 400) * 0.1).alias("lat_min"), "id"
    )
    boxes = cities.select(
        "lon_min", (F.col("lon_min") + 0.1).alias("lon_max"), "lat_min", (F.col("lat_min") + 0.1).alias("lat_max"),
        F.lit("p").alias("province"), F.col("id").cast("string").alias("city"),
    ).unionByName(spark.createDataFrame([(0.0, 40.0, 0.0, 25.0, "p", "country")], BOX))
    cells = _laid_out(boxes)
    per_box = cells.groupBy("city").count().agg(F.max("count")).first()[0]
    per_cell = cells.groupBy("_level", "_lon", "_lat").count().agg(F.max("count")).first()[0]
    assert per_box <= 4 and per_cell <= 16


def test_kafka_options():
    conf = {
        "bootstrap.servers": "h1:9092,h2:9092",
        "kafka.input.topics": "live, shop",
        "auto.offset.reset": "earliest",
        "isolation.level": "read_committed",
        "group.id": "g",
    }
    assert kafka_options(conf) == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "live,shop",
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
        "failOnDataLoss": "true",
        "groupIdPrefix": "g",
    }
    assert kafka_options(conf, "ordermain")["subscribe"] == "ordermain"


DOUBTFUL = (
    '{"deviceId":"a","timestamp":1,"properties":{"k":69}}', "{}", "{bad", "", None, "null", "[1]",
    '{"deviceId":"x"} tail', '{"timestamp":"soon"}', '{"isNew":"x","timestamp":"soon"}', '{"latitude":"north"}',
    ' {"deviceId":"b","isNew":"null"}\n',
)


def test_rejected_events_have_a_reason(spark):
    raw = spark.createDataFrame(list(enumerate(DOUBTFUL)), "n int, value string")
    checked = checked_events(raw)
    assert checked.columns == ["n", "value", "event", "reason"]
    got = {r["n"]: (r["event"] is not None, r["reason"]) for r in checked.collect()}
    none, time = (False, "no single object"), (False, "bad value: timestamp")
    assert got == {
        0: (True, None), 1: (True, None), 2: none, 3: none, 4: none, 5: none, 6: none, 7: none, 8: time,
        9: time, 10: (False, "bad value: latitude"), 11: (True, None),
    }
    # What is kept is what the parser gives.
    assert rows(checked.where("reason IS NULL").select("event.*").drop("properties")) == rows(
        parse_events(raw).drop("properties")
    )


def test_rejections_are_counted_with_the_batch(spark):
    from pyspark.sql import Observation

    raw = spark.createDataFrame(list(enumerate(DOUBTFUL)), "n int, value string")
    seen = Observation("records")
    checked = checked_events(raw)
    observed = checked.observe(
        seen, F.count_if(F.col("reason").isNull()).alias("kept"), F.count_if(F.col("reason").isNotNull()).alias("rejected")
    )
    assert observed.count() == len(DOUBTFUL)
    assert seen.get == {"kept": 3, "rejected": len(DOUBTFUL) - 3}
    assert counted(checked, "records").columns == checked.columns


def test_rejected_items_and_envelopes(spark):
    raw = texts(
        spark,
        '{"type":"INSERT","data":[{"id":"1","sku":"2"},{"id":"one"},null,{"id":3,"money":"much"}]}',
        '{"type":"UPDATE","data":[]}', '{"type":"UPDATE"}', '{"type":"ALTER","data":[{"id":"x"}]}',
        '{"data":[{"id":"1"}]}', "{", None, '{"type":"DELETE","data":[{}]} x',
    )
    checked = checked_cdc(raw, ORDER_DETAIL)
    got = sorted((r["type"] or "", -1 if r["place"] is None else r["place"], r["reason"] or "") for r in checked.collect())
    assert got == [
        ("", -1, "no single object"), ("", -1, "no single object"), ("", -1, "no single object"),
        ("INSERT", 0, ""), ("INSERT", 1, "bad value: id"), ("INSERT", 2, "no item"), ("INSERT", 3, "bad value: money"),
        ("UPDATE", -1, "no items"), ("UPDATE", -1, "no items"),
    ]
    kept = checked.where("reason IS NULL").select("item.*", "type")
    assert rows(kept) == rows(parse_cdc(raw, ORDER_DETAIL))
