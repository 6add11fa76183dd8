"""Worked examples with known results."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows
from tidecast.functions import columns as C
from tidecast.operators import orders, users
from tidecast.schemas import (
    ACTIVITY_LINE,
    CATEGORY_LINE,
    GROUP_DETAIL_LINE,
    GROUP_MAIN_LINE,
    GROUP_ORDER_LINE,
)
from tidecast.sources.records import parse_delimited


def lines(spark, *text):
    return spark.createDataFrame([(t,) for t in text], "value string")


ACTIVITY = (
    ["u1,A1,view"] * 3 + ["u1,A1,join"] * 2 + ["u2,A1,view", "u2,A1,join"]
    + ["u1,A2,view"] * 2 + ["u1,A2,join"]
)


def test_activity(spark):
    df = parse_delimited(lines(spark, *ACTIVITY), ACTIVITY_LINE)
    want = [
        ("A1", "join", 2, 3), ("A1", "view", 2, 4),
        ("A2", "join", 1, 1), ("A2", "view", 1, 2),
    ]
    assert rows(users.pv_uv(df)) == want
    assert rows(users.pv_uv(df, approx=True)) == want


def test_approx_is_close(spark):
    df = spark.range(30_000).select(
        F.lit("A").alias("activity"), F.lit("view").alias("event"),
        (F.col("id") % 9_000).alias("uid"),
    )
    uv, pv = users.pv_uv(df, approx=True).select("uv", "pv").first()
    assert pv == 30_000 and abs(uv - 9_000) <= 0.1 * 9_000


def group_inputs(spark):
    mains = parse_delimited(
        lines(spark, "1000,p201,1,手机", "5001,p202,1,手机"), GROUP_MAIN_LINE
    )
    details = parse_delimited(
        lines(spark, "1000,u1646,p201,o1002", "5001,u1647,p202,o1003"),
        GROUP_DETAIL_LINE,
    )
    paid = parse_delimited(
        lines(spark, "1001,o1002,102,200.0", "5002,o1003,101,3000.0"), GROUP_ORDER_LINE
    )
    return details, paid, mains


GROUP_COLUMNS = ("user_id", "order_status", "order_amount", "group_status", "group_category")


def test_group_buy(spark):
    got = orders.group_buy(*group_inputs(spark))
    assert rows(got, *GROUP_COLUMNS) == [
        ("u1646", "102", 200.0, "1", "手机"),
        ("u1647", "101", 3000.0, "1", "手机"),
    ]


def test_group_buy_keeps_lone_details(spark):
    details, paid, mains = group_inputs(spark)
    lone = details.withColumn("ts", F.col("ts") + 100_000)
    assert rows(orders.group_buy(lone, paid, mains), *GROUP_COLUMNS) == [
        ("u1646", None, None, None, None),
        ("u1647", None, None, None, None),
    ]


def test_times(spark):
    df = spark.createDataFrame([(1682565505,)], "s bigint")
    ms = F.col("s") * 1000
    got = df.select(
        C.seconds_date_hour("s"), C.date_text(ms), C.hour_text(ms),
        C.hour_text(ms, "Asia/Shanghai"), C.date_text(F.lit(72_000_000), "Asia/Shanghai"),
    ).first()
    assert tuple(got) == ("20230427-03", "20230427", "03", "11", "19700102")


def test_literal_total(spark):
    counts = spark.createDataFrame([("a", 1, 3), ("b", 1, 2)], "t string, isNew int, users bigint")
    assert rows(users.total_users(counts)) == [(1, 5)]
    assert rows(users.total_users(counts, literal=True)) == [(1, 6 + 3)]


def test_category_lines(spark):
    text = lines(spark, "shoes-3", "shoes-4", "hats-x", "hats", "hats-1-9")
    got = parse_delimited(text, CATEGORY_LINE, sep="-")
    assert rows(got) == [("hats", 1), ("shoes", 3), ("shoes", 4)]


def test_join_text_prints_null(spark):
    df = spark.createDataFrame([("a", None)], "x string, y int")
    assert df.select(C.join_text(",", "x", "y")).first()[0] == "a,null"


def test_floor_and_durations(spark):
    df = spark.createDataFrame([(12_345,), (-1,)], "t bigint")
    assert rows(df.select(C.floor_ms("t", 10_000))) == [(-10_000,), (10_000,)]
    assert C.duration_ms("30 minutes") == 1_800_000 and C.duration_ms(5) == 5
