"""The operators' inputs, built from the test tables in Spark and in SQL alike.

``k`` is the number in ``events.props``. Device type and channel come from it and
not from the user, so that first-seen per type and first-seen overall differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from ..streaming.runs import stream_files

DAY = 86_400_000

# Event names of the test table and what they stand for.
LIVE_NAMES = {
    "signup": "appLaunch",
    "view": "liveEnter",
    "click": "liveLeave",
    "purchase": "liveReward",
    "error": "clientError",
}
PRODUCT_NAMES = {
    "view": "productView",
    "click": "productAddCart",
    "purchase": "productOrder",
    "signup": "appLaunch",
    "error": "clientError",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The time column by which a table's rows arrive.
ARRIVES_BY = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
BATCHES = 4
_portions: dict[tuple[str, str, str], tuple[str, int]] = {}


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table's rows as a stream of ``BATCHES`` micro-batches in order of time.

    The portions are files in the shared folder, written once per application. Within
    a portion the rows are in no order.
    """
    key = (spark.sparkContext.applicationId, folder, name)
    rows = table(spark, folder, name)
    if key not in _portions:
        path = shared_folder(spark, f"arriving-{name}")
        at = millis(ARRIVES_BY[name])
        shares = [i / BATCHES for i in range(1, BATCHES)]
        cuts = rows.agg(F.percentile_approx(at, shares, 1000)).first()[0] or []
        portion = sum(((at > cut).cast("int") for cut in cuts), F.lit(0))
        _portions[key] = path, write_portions(rows, portion, path)
    path, files = _portions[key]
    return stream_files(spark, rows, path, "*.parquet", files)


def write_portions(rows: DataFrame, portion, path: str) -> int:
    """Write each portion as equally many files, one after the other; how many they are.

    A stream that reads so many files per trigger takes one portion per micro-batch.
    """
    sizes = rows.groupBy(portion.alias("portion")).count().collect()
    smallest = min((r["count"] for r in sizes), default=0)
    # Every file of a portion gets rows, else there would be fewer of them.
    files = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, smallest // 16))
    for number in range(BATCHES):
        part = rows.where(portion == number).repartition(files)
        part.write.mode("append").parquet(path)
    return files


def millis(column: str):
    return F.unix_millis(F.col(column).cast("timestamp"))


def _named(names: dict[str, str]):
    name = F.lit(None).cast("string")
    for old, new in names.items():
        name = F.when(F.col("event_type") == old, new).otherwise(name)
    return name


def _numbered(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("event_id").alias("id"),
        millis("ts").alias("timestamp"),
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def live_events(raw: DataFrame) -> DataFrame:
    """App launches, room enters and leaves, rewards, client errors, from ``events``."""
    k, user = F.col("k"), F.col("user_id")
    anchor = F.when(F.col("event_type") == "purchase", user % 10).otherwise(k % 10)
    return _numbered(raw).select(
        "id",
        "timestamp",
        user.cast("string").alias("deviceId"),
        F.concat(F.lit("type"), k % 7).alias("deviceType"),
        F.concat(F.lit("channel"), k % 5).alias("releaseChannel"),
        F.concat(F.lit("os"), k % 3).alias("osName"),
        (user % 2).cast("int").alias("isNew"),
        _named(LIVE_NAMES).alias("eventId"),
        ((user * 37) % 360 - 180).cast("double").alias("longitude"),
        ((user * 17) % 180 - 90).cast("double").alias("latitude"),
        F.create_map(
            F.lit("anchor_id"), anchor.cast("string"),
            F.lit("gift_id"), k.cast("string"),
        ).alias("properties"),
    )


LIVE_SQL = """
ev AS (
  SELECT event_id AS id, (epoch_us(ts) // 1000) AS "timestamp", user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
live AS (
  SELECT id, "timestamp", CAST(user_id AS VARCHAR) AS "deviceId",
         'type' || (k % 7) AS "deviceType", 'channel' || (k % 5) AS "releaseChannel",
         'os' || (k % 3) AS "osName", CAST(user_id % 2 AS INTEGER) AS "isNew",
         CASE event_type WHEN 'signup' THEN 'appLaunch' WHEN 'view' THEN 'liveEnter'
              WHEN 'click' THEN 'liveLeave' WHEN 'purchase' THEN 'liveReward'
              WHEN 'error' THEN 'clientError' END AS "eventId",
         CAST((user_id * 37) % 360 - 180 AS DOUBLE) AS longitude,
         CAST((user_id * 17) % 180 - 90 AS DOUBLE) AS latitude,
         CAST(CASE WHEN event_type = 'purchase' THEN user_id % 10 ELSE k % 10 END
              AS VARCHAR) AS anchor_id,
         k AS gift_id
  FROM ev)"""

VISITS_SQL = (
    LIVE_SQL
    + """,
visits AS (
  SELECT *, CASE WHEN "eventId" = 'liveEnter' THEN 1 ELSE 0 END AS entered
  FROM live WHERE "eventId" IN ('liveEnter', 'liveLeave'))"""
)


def shop_events(raw: DataFrame) -> DataFrame:
    """Product views, cart additions, orders and events of other kinds, from ``events``."""
    return _numbered(raw).select(
        "id",
        "timestamp",
        _named(PRODUCT_NAMES).alias("eventId"),
        F.create_map(
            F.lit("categoryId"), (F.col("k") % 10).cast("string"),
            F.lit("productId"), F.col("k").cast("string"),
        ).alias("properties"),
    )


SHOP_SQL = """
shop AS (
  SELECT event_id AS id, (epoch_us(ts) // 1000) AS "timestamp",
         CASE event_type WHEN 'view' THEN 'productView' WHEN 'click' THEN 'productAddCart'
              ELSE 'productOrder' END AS "eventId",
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS VARCHAR)
           AS "categoryId",
         json_extract_string(props, '$.k') AS "productId"
  FROM events WHERE event_type IN ('view', 'click', 'purchase'))"""


def raw_records(raw: DataFrame) -> DataFrame:
    """Kafka-shaped records with one JSON event each.

    White space stands around some; client errors are cut short, or have text behind.
    """
    e = _numbered(raw)
    text = F.concat(
        F.lit('{"deviceId":"'), F.col("user_id"),
        F.lit('","eventId":"'), _named(LIVE_NAMES),
        F.lit('","timestamp":'), F.col("timestamp"),
        F.lit(',"isNew":'), F.col("user_id") % 2,
        F.lit(',"properties":{"anchor_id":"'), F.col("k") % 10,
        F.lit('","gift_id":'), F.col("k"), F.lit("}}"),
    )
    cut = F.when(F.col("id") % 2 == 0, F.substring(text, 1, 20)).otherwise(
        F.concat(text, F.lit(" junk}"))
    )
    ends = F.element_at(
        F.array(*[F.lit(x) for x in ("", "\n", "\r\n", " \t")]), (F.col("id") % 4 + 1).cast("int")
    )
    text = F.concat(F.when(F.col("id") % 3 == 0, "\t").otherwise(""), text, ends)
    return e.select(
        F.lit("live").alias("topic"),
        (F.col("id") % 3).cast("int").alias("partition"),
        F.col("id").alias("offset"),
        F.encode(F.when(F.col("event_type") == "error", cut).otherwise(text), "UTF-8")
        .alias("value"),
    )


RECORDS_SQL = (
    LIVE_SQL
    + """,
texts AS (
  SELECT id, event_type,
         '{"deviceId":"' || user_id || '","eventId":"' ||
         CASE event_type WHEN 'signup' THEN 'appLaunch' WHEN 'view' THEN 'liveEnter'
              WHEN 'click' THEN 'liveLeave' WHEN 'purchase' THEN 'liveReward'
              WHEN 'error' THEN 'clientError' END ||
         '","timestamp":' || "timestamp" || ',"isNew":' || (user_id % 2) ||
         ',"properties":{"anchor_id":"' || (k % 10) || '","gift_id":' || k || '}}' AS text
  FROM ev),
records AS (
  SELECT 'live-' || (id % 3) || '-' || id AS id, event_type,
         CASE WHEN event_type <> 'error' THEN
                CASE WHEN id % 3 = 0 THEN chr(9) ELSE '' END || text ||
                CASE id % 4 WHEN 1 THEN chr(10) WHEN 2 THEN chr(13) || chr(10)
                            WHEN 3 THEN ' ' || chr(9) ELSE '' END
              WHEN id % 2 = 0 THEN substr(text, 1, 20) ELSE text || ' junk}' END AS value
  FROM texts)"""
)


def gift_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Two changes per gift, from ``part``; the change with the larger key is newer."""
    return table(spark, folder, "part").select(
        F.floor(F.col("p_partkey") / 2).cast("int").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("points"),
        (F.col("p_size") % 5 == 0).cast("int").alias("deleted"),
        F.col("p_partkey").alias("updateTime"),
    )


# Every gift changes several times while the events last.
CHANGES_FROM, CHANGE_STEP, CHANGE_STEPS = 1_704_067_200_000, 1_000_000, 2592


def gift_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of a hundred gifts over the events' time, from ``part``."""
    change = F.col("p_partkey")
    step = change * 7919 % CHANGE_STEPS
    return table(spark, folder, "part").select(
        (change % 100).cast("int").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("points"),
        (F.col("p_size") % 5 == 0).cast("int").alias("deleted"),
        (F.lit(CHANGES_FROM) + step * CHANGE_STEP).alias("updateTime"),
        change.alias("change"),
    )


VERSIONS_SQL = f"""
every_version AS (
  SELECT CAST(p_partkey % 100 AS INTEGER) AS id, p_name AS name, p_retailprice AS points,
         CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS deleted, p_partkey AS change,
         {CHANGES_FROM} + p_partkey * 7919 % {CHANGE_STEPS} * {CHANGE_STEP} AS "updateTime"
  FROM part),
versions AS (
  SELECT * FROM every_version
  QUALIFY row_number() OVER (PARTITION BY id, "updateTime" ORDER BY change DESC) = 1)"""

GIFTS_SQL = """
changes AS (
  SELECT CAST(p_partkey // 2 AS INTEGER) AS id, p_name AS name, p_retailprice AS points,
         CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS deleted, p_partkey AS "updateTime"
  FROM part),
gifts AS (
  SELECT id, name, points, deleted FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY "updateTime" DESC) AS r
    FROM changes) WHERE r = 1 AND deleted = 0)"""


def regions(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes on a 5 x 5 layout with gaps, one per nation."""
    n = F.col("n_nationkey")
    lon = (n % 5) * 60 - 160
    lat = F.floor(n / 5) * 30 - 75
    return table(spark, folder, "nation").select(
        lon.cast("double").alias("lon_min"),
        (lon + 50).cast("double").alias("lon_max"),
        lat.cast("double").alias("lat_min"),
        (lat + 25).cast("double").alias("lat_max"),
        F.col("n_name").alias("province"),
        F.concat(F.lit("CITY_"), n).alias("city"),
    )


REGIONS_SQL = """
regions AS (
  SELECT (n_nationkey % 5) * 60 - 160 AS lon_min, (n_nationkey % 5) * 60 - 110 AS lon_max,
         (n_nationkey // 5) * 30 - 75 AS lat_min, (n_nationkey // 5) * 30 - 50 AS lat_max,
         n_name AS province, 'CITY_' || n_nationkey AS city
  FROM nation)"""

# Order windows are long because the test orders span years.
ORDER_WINDOW = "180 days"
ORDER_WINDOW_MS = 180 * DAY
STATUS = {"O": 0, "F": 1, "P": 2}


def order_main(orders: DataFrame) -> DataFrame:
    """Orders as captured changes, from ``orders``."""
    status = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])
    return orders.select(
        F.col("o_orderkey").alias("oid"),
        F.col("o_totalprice").alias("total_money"),
        status[F.col("o_orderstatus")].alias("status"),
        F.col("o_custkey").alias("uid"),
        F.col("o_orderpriority").alias("province"),
        millis("o_orderdate").alias("main_update_ms"),
    )


def order_detail(lineitem: DataFrame) -> DataFrame:
    """Order details, from ``lineitem``."""
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("sku"),
        F.col("l_suppkey").alias("category_id"),
        F.col("l_extendedprice").alias("money"),
        F.col("l_quantity").cast("int").alias("amount"),
        millis("l_shipdate").alias("update_ms"),
    )


# Details arrive up to 60 days after their own time.
ARRIVAL = ("arrival", "order_id", "line", "sku", "category_id", "update_ms")


def arriving_details(lineitem: DataFrame) -> DataFrame:
    delay_days = (F.col("sku") * 7919 + F.col("category_id")) % 60
    return order_detail(lineitem).withColumn(
        "arrival", F.col("update_ms") + delay_days * DAY
    )


ORDERS_SQL = f"""
mains AS (
  SELECT o_orderkey AS oid, o_totalprice AS total_money,
         CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 WHEN 'P' THEN 2 END AS status,
         o_custkey AS uid, o_orderpriority AS province, (epoch_us(o_orderdate) // 1000) AS main_update_ms,
         (epoch_us(o_orderdate) // 1000) // {ORDER_WINDOW_MS} * {ORDER_WINDOW_MS} AS main_window
  FROM orders),
details AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS sku,
         l_suppkey AS category_id, l_extendedprice AS money,
         CAST(l_quantity AS INTEGER) AS amount, (epoch_us(l_shipdate) // 1000) AS update_ms,
         (epoch_us(l_shipdate) // 1000) // {ORDER_WINDOW_MS} * {ORDER_WINDOW_MS} AS "windowStart",
         (epoch_us(l_shipdate) // 1000) + (l_partkey * 7919 + l_suppkey) % 60 * {DAY} AS arrival
  FROM lineitem)"""


def group_details(lineitem: DataFrame) -> DataFrame:
    """Members of group purchases, from ``lineitem``."""
    return lineitem.select(
        millis("l_shipdate").alias("ts"),
        F.col("l_partkey").cast("string").alias("user_id"),
        F.col("l_suppkey").cast("string").alias("group_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
    )


def group_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        millis("o_orderdate").alias("ts"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
    )


def group_mains(lineitem: DataFrame) -> DataFrame:
    """One group per supplier and year, opened with its first detail."""
    return (
        lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("_year"))
        .agg(F.min("l_shipdate").alias("opened"))
        .select(
            millis("opened").alias("ts"),
            F.col("l_suppkey").cast("string").alias("group_id"),
            F.lit("1").alias("status"),
            F.concat(F.lit("category"), F.col("l_suppkey") % 5).alias("category"),
        )
    )


GROUPS_SQL = f"""
members AS (
  SELECT (epoch_us(l_shipdate) // 1000) AS ts, CAST(l_partkey AS VARCHAR) AS user_id,
         CAST(l_suppkey AS VARCHAR) AS group_id, CAST(l_orderkey AS VARCHAR) AS order_id,
         (epoch_us(l_shipdate) // 1000) // {ORDER_WINDOW_MS} * {ORDER_WINDOW_MS} AS "windowStart"
  FROM lineitem),
group_orders AS (
  SELECT (epoch_us(o_orderdate) // 1000) AS order_ts, CAST(o_orderkey AS VARCHAR) AS order_id,
         o_orderstatus AS order_status, o_totalprice AS order_amount,
         (epoch_us(o_orderdate) // 1000) // {ORDER_WINDOW_MS} * {ORDER_WINDOW_MS} AS w
  FROM orders),
opened AS (
  SELECT l_suppkey, (epoch_us(min(l_shipdate)) // 1000) AS group_ts
  FROM lineitem GROUP BY l_suppkey, year(l_shipdate)),
group_mains AS (
  SELECT group_ts, CAST(l_suppkey AS VARCHAR) AS group_id, '1' AS group_status,
         'category' || (l_suppkey % 5) AS group_category,
         group_ts // {ORDER_WINDOW_MS} * {ORDER_WINDOW_MS} AS w
  FROM opened)"""
