"""Sources, parsing, projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators import filters
from ..operators.location import enrich_location, join_locations
from ..schemas import ACTIVITY_LINE, GROUP_ORDER_LINE, ORDER_DETAIL, ORDER_MAIN
from ..session import shared_folder
from ..sources.json_records import checked_cdc, checked_events, parse_cdc, parse_events
from ..sources.records import (
    parse_delimited,
    read_record_files,
    record_values,
    with_record_id,
)
from ..streaming.runs import append_to_table
from . import inputs
from .registry import query


def records(spark, folder):
    return inputs.raw_records(inputs.table(spark, folder, "events"))


def record_stream(spark, folder):
    """The records as files in the shared folder, read as a stream."""
    path = shared_folder(spark, "records")
    records(spark, folder).write.parquet(path)
    return read_record_files(spark, path)


@query("source_value_stream", f"WITH {inputs.RECORDS_SQL} SELECT value FROM records")
def _value_stream(spark, folder):
    return append_to_table(
        record_values(record_stream(spark, folder)), "source-values"
    )


@query("source_with_record_id", f"WITH {inputs.RECORDS_SQL} SELECT id, value FROM records")
def _record_id(spark, folder):
    return append_to_table(with_record_id(record_stream(spark, folder)), "source-ids")


PARSED_SQL = f"""WITH {inputs.RECORDS_SQL}
    SELECT <id> json_extract_string(value, '$.deviceId') AS "deviceId",
           json_extract_string(value, '$.eventId') AS "eventId",
           CAST(json_extract_string(value, '$.timestamp') AS BIGINT) AS "timestamp",
           CAST(json_extract_string(value, '$.isNew') AS INTEGER) AS "isNew",
           CAST(0 AS INTEGER) AS "isN",
           json_extract_string(value, '$.properties.anchor_id') AS anchor_id,
           json_extract_string(value, '$.properties.gift_id') AS gift_id
    FROM records WHERE event_type <> 'error'"""


def _parsed(events, *extra):
    return events.select(
        *extra, "deviceId", "eventId", "timestamp", "isNew", "isN",
        C.prop("anchor_id").alias("anchor_id"), C.prop("gift_id").alias("gift_id"),
    )


@query("parse_event_json", PARSED_SQL.replace("<id>", ""))
def _parse(spark, folder):
    return _parsed(parse_events(record_values(records(spark, folder))))


@query("parse_event_json_with_id", PARSED_SQL.replace("<id>", "id,"))
def _parse_with_id(spark, folder):
    rows = with_record_id(records(spark, folder))
    return _parsed(parse_events(rows, id_column="id"), "id")


REJECTED_SQL = f"""WITH {inputs.LIVE_SQL}
    SELECT 'live-' || (id % 3) || '-' || id AS id, event_type <> 'error' AND id % 9 <> 0 AS kept,
           CASE WHEN event_type = 'error' THEN 'no single object'
                WHEN id % 9 = 0 THEN 'bad value: timestamp' END AS reason
    FROM ev"""


def doubtful_records(raw):
    """Records of which some hold a time that is no number."""
    text = F.col("value").cast("string")
    bad = F.regexp_replace(text, '"timestamp":[0-9]+', '"timestamp":"soon"')
    value = F.when(F.col("offset") % 9 == 0, bad).otherwise(text)
    return with_record_id(raw.withColumn("value", F.encode(value, "UTF-8")))


@query("rejected_event_records", REJECTED_SQL)
def _rejected(spark, folder):
    """Every record, with the reason where it is rejected."""
    checked = checked_events(doubtful_records(records(spark, folder)))
    return checked.select("id", F.col("event").isNotNull().alias("kept"), "reason")


def _quoted(name: str, value):
    return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))


def _envelopes(rows, key: str, *items):
    """One envelope per row, with quoted values as capture tools write them."""
    kind = F.element_at(
        F.array(*[F.lit(t) for t in ("INSERT", "UPDATE", "DELETE", "ALTER")]),
        (F.col(key) % 4).cast("int") + 1,
    )
    return rows.select(
        F.concat(
            F.lit('{"type":"'), kind, F.lit('","data":['),
            F.concat_ws(",", *items), F.lit("]}"),
        ).alias("value")
    )


def _cdc_type(key: str) -> str:
    return f"CASE {key} % 4 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' ELSE 'DELETE' END"


@query(
    "parse_cdc_order_main",
    f"""SELECT CAST(o_orderkey AS INTEGER) AS oid, o_totalprice AS total_money,
           CAST(o_custkey AS INTEGER) AS uid, o_orderpriority AS province,
           (epoch_us(o_orderdate) // 1000) AS update_ms, {_cdc_type("o_orderkey")} AS type
    FROM orders WHERE o_orderkey % 4 <> 3""",
)
def _cdc_main(spark, folder):
    rows = inputs.table(spark, folder, "orders")
    item = F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            _quoted("oid", F.col("o_orderkey")),
            _quoted("total_money", F.col("o_totalprice")),
            _quoted("uid", F.col("o_custkey")),
            _quoted("province", F.col("o_orderpriority")),
            _quoted("update_time", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
        ),
        F.lit("}"),
    )
    parsed = parse_cdc(_envelopes(rows, "o_orderkey", item), ORDER_MAIN)
    return parsed.select(
        "oid", "total_money", "uid", "province",
        F.unix_millis("update_time").alias("update_ms"), "type",
    )


# Each envelope holds a line and a copy of it with a line number seven higher.
DETAIL_CDC_SQL = f"""
    SELECT CAST(l_linenumber + d AS INTEGER) AS id, CAST(l_orderkey AS INTEGER) AS order_id,
           CAST(l_partkey AS INTEGER) AS sku, l_extendedprice AS money,
           CAST(l_quantity AS INTEGER) AS amount, (epoch_us(l_shipdate) // 1000) AS update_ms,
           {_cdc_type("l_orderkey")} AS type
    FROM lineitem, (VALUES (0), (7)) AS copies(d) WHERE l_orderkey % 4 <> 3"""


def _detail_envelopes(spark, folder):
    rows = inputs.table(spark, folder, "lineitem")

    def item(line):
        return F.concat(
            F.lit("{"), F.concat_ws(",", _quoted("id", line), rest), F.lit("}")
        )

    rest = F.concat_ws(
        ",",
        _quoted("order_id", F.col("l_orderkey")),
        _quoted("sku", F.col("l_partkey")),
        _quoted("money", F.col("l_extendedprice")),
        _quoted("amount", F.col("l_quantity").cast("int")),
        _quoted("update_time", inputs.millis("l_shipdate")),
    )
    line = F.col("l_linenumber")
    return _envelopes(rows, "l_orderkey", item(line), item(line + 7))


@query("parse_cdc_order_detail", DETAIL_CDC_SQL)
def _cdc_detail(spark, folder):
    parsed = parse_cdc(_detail_envelopes(spark, folder), ORDER_DETAIL)
    return parsed.select(
        "id", "order_id", "sku", "money", "amount",
        F.unix_millis("update_time").alias("update_ms"), "type",
    )


@query(
    "rejected_cdc_items",
    f"""SELECT {_cdc_type("l_orderkey")} AS type,
           CASE WHEN l_partkey % 10 = 0 THEN 'bad value: sku' END AS reason, 2 * count(*) AS items
    FROM lineitem WHERE l_orderkey % 4 <> 3 GROUP BY ALL""",
)
def _rejected_items(spark, folder):
    """Items of the change envelopes by type and reason; some have a text for a number."""
    raw = _detail_envelopes(spark, folder)
    raw = raw.withColumn("value", F.regexp_replace("value", '"sku":"[0-9]*0"', '"sku":"none"'))
    return checked_cdc(raw, ORDER_DETAIL).groupBy("type", "reason").agg(F.count("*").alias("items"))


@query(
    "filter_cdc_ops",
    f"""SELECT {_cdc_type("l_orderkey")} AS type, 2 * count(*) AS items
    FROM lineitem WHERE l_orderkey % 4 IN (0, 2) GROUP BY ALL""",
)
def _cdc_ops(spark, folder):
    parsed = parse_cdc(
        _detail_envelopes(spark, folder), ORDER_DETAIL, ops=("INSERT", "DELETE")
    )
    return parsed.groupBy("type").agg(F.count("*").alias("items"))


@query(
    "parse_delimited",
    """SELECT CAST(user_id AS VARCHAR) AS uid, 'A' || (event_id % 4) AS activity,
              event_type AS event
    FROM events WHERE event_type <> 'error'""",
)
def _delimited(spark, folder):
    whole = F.col("event_type") != "error"
    lines = inputs.table(spark, folder, "events").select(
        F.concat_ws(
            ",",
            F.col("user_id"),
            F.concat(F.lit("A"), F.col("event_id") % 4),
            F.when(whole, F.col("event_type")),
        ).alias("value")
    )
    return parse_delimited(lines, ACTIVITY_LINE)


@query(
    "parse_delimited_typed",
    """SELECT (epoch_us(o_orderdate) // 1000) AS ts, CAST(o_orderkey AS VARCHAR) AS order_id,
              o_orderstatus AS status, o_totalprice AS amount
    FROM orders WHERE o_orderstatus <> 'P'""",
)
def _delimited_typed(spark, folder):
    priced = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string"))
    lines = inputs.table(spark, folder, "orders").select(
        F.concat_ws(
            ",",
            inputs.millis("o_orderdate"),
            "o_orderkey",
            "o_orderstatus",
            F.coalesce(priced, F.lit("pending")),
        ).alias("value")
    )
    return parse_delimited(lines, GROUP_ORDER_LINE)


@query(
    "derive_date_hour",
    """SELECT event_id AS id, strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour
    FROM events""",
)
def _date_hour(spark, folder):
    return _live(spark, folder).select(
        "id", C.date_text("timestamp").alias("date"), C.hour_text("timestamp").alias("hour")
    )


@query(
    "derive_date_hour_zone",
    """SELECT event_id AS id, strftime(ts + INTERVAL 8 HOUR, '%Y%m%d') AS date,
              strftime(ts + INTERVAL 8 HOUR, '%H') AS hour
    FROM events""",
)
def _date_hour_zone(spark, folder):
    zone = "Asia/Shanghai"
    return _live(spark, folder).select(
        "id",
        C.date_text("timestamp", zone).alias("date"),
        C.hour_text("timestamp", zone).alias("hour"),
    )


LOCATION_SQL = f"""WITH {inputs.LIVE_SQL}, {inputs.REGIONS_SQL}
    SELECT id, longitude, latitude, province, city
    FROM live LEFT JOIN regions
      ON longitude >= lon_min AND longitude < lon_max
     AND latitude >= lat_min AND latitude < lat_max"""


@query("enrich_location", LOCATION_SQL)
def _location(spark, folder):
    placed = enrich_location(_live(spark, folder), inputs.regions(spark, folder))
    return placed.select("id", "longitude", "latitude", "province", "city")


@query("location_join", LOCATION_SQL)
def _location_join(spark, folder):
    """The form for large region tables, on a finer grid."""
    placed = join_locations(
        _live(spark, folder).select("id", "longitude", "latitude"),
        inputs.regions(spark, folder),
    )
    return placed.select("id", "longitude", "latitude", "province", "city")


def _live(spark, folder):
    return inputs.live_events(inputs.table(spark, folder, "events"))


def _where_sql(condition: str) -> str:
    return f"""WITH {inputs.LIVE_SQL}
    SELECT id, "timestamp", "deviceId", "eventId" FROM live WHERE {condition}"""


def _columns(df):
    return df.select("id", "timestamp", "deviceId", "eventId")


@query("filter_app_launch", _where_sql("\"eventId\" = 'appLaunch'"))
def _app_launch(spark, folder):
    return _columns(filters.app_launches(_live(spark, folder)))


@query("filter_event_prefix", _where_sql("starts_with(\"eventId\", 'live')"))
def _prefix(spark, folder):
    return _columns(filters.filter_events(_live(spark, folder), prefix="live"))


@query("filter_enter_leave", _where_sql("\"eventId\" IN ('liveEnter', 'liveLeave')"))
def _enter_leave(spark, folder):
    return _columns(filters.room_visits(_live(spark, folder)))


@query("filter_reward", _where_sql("\"eventId\" = 'liveReward'"))
def _reward(spark, folder):
    return _columns(filters.rewards(_live(spark, folder)))


@query(
    "project_tuple",
    f"""WITH {inputs.LIVE_SQL}
    SELECT "deviceType", "isNew", CAST(1 AS INTEGER) AS one FROM live
    WHERE "eventId" = 'appLaunch'""",
)
def _project(spark, folder):
    return filters.app_launches(_live(spark, folder)).select(
        "deviceType", "isNew", F.lit(1).alias("one")
    )


@query(
    "map_property",
    f"""WITH {inputs.LIVE_SQL}
    SELECT id, anchor_id, gift_id, CAST(NULL AS VARCHAR) AS missing,
           CAST(NULL AS INTEGER) AS not_a_number
    FROM live""",
)
def _map_property(spark, folder):
    rows = _live(spark, folder).withColumn(
        "properties", F.map_concat("properties", F.create_map(F.lit("x"), F.lit("abc")))
    )
    return rows.select(
        "id",
        C.prop("anchor_id").alias("anchor_id"),
        C.int_prop("gift_id").alias("gift_id"),
        C.prop("absent").alias("missing"),
        C.int_prop("x").alias("not_a_number"),
    )


@query(
    "scalar_functions",
    """SELECT event_id AS id, starts_with(event_type, 's') AS starts_s,
              CAST(event_id % 100 AS INTEGER) AS second_part,
              event_type || '-' || user_id || '_null' AS joined,
              event_type AS decoded,
              CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS INTEGER) END
                AS parsed_int,
              strftime(date_trunc('second', ts), '%Y%m%d-%H') AS seconds_text,
              json_extract_string(props, '$.k') AS json_k,
              (epoch_us(ts) // 1000) // 10000 * 10000 AS ten_seconds
    FROM events""",
)
def _scalars(spark, folder):
    e = inputs.table(spark, folder, "events")
    parts = F.split(F.concat_ws(",", "event_type", F.col("event_id") % 100), ",")
    number = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(
        F.col("user_id").cast("string")
    )
    name = C.join_text("-", "event_type", "user_id")
    props = T.StructType([T.StructField("k", T.StringType())])
    return e.select(
        F.col("event_id").alias("id"),
        F.col("event_type").startswith("s").alias("starts_s"),
        F.get(parts, F.lit(1)).try_cast("int").alias("second_part"),
        C.join_text("_", name, F.lit(None).cast("string")).alias("joined"),
        C.utf8(F.encode("event_type", "UTF-8")).alias("decoded"),
        number.try_cast("int").alias("parsed_int"),
        C.seconds_date_hour(F.floor(inputs.millis("ts") / 1000)).alias("seconds_text"),
        F.from_json("props", props)["k"].alias("json_k"),
        C.floor_ms(inputs.millis("ts"), 10_000).alias("ten_seconds"),
    )
