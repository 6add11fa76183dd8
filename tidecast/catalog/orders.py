"""Order and group-purchase matching, late rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import orders
from . import inputs
from .registry import query

DELAY = "2 days"
DELAY_MS = 2 * inputs.DAY


def details(spark, folder):
    return inputs.order_detail(inputs.table(spark, folder, "lineitem"))


def mains(spark, folder):
    return inputs.order_main(inputs.table(spark, folder, "orders"))


def order_table(spark, folder):
    """The order table as the lookup sees it."""
    return mains(spark, folder).drop("main_update_ms")


DETAIL_COLUMNS = (
    'order_id, line, sku, category_id, money, amount, update_ms, "windowStart"'
)
JOIN_SQL = f"""WITH {inputs.ORDERS_SQL}
    SELECT {DETAIL_COLUMNS}, oid, total_money, status, uid, province, main_update_ms
    FROM details LEFT JOIN mains ON order_id = oid AND "windowStart" = main_window"""


@query("order_detail_left_join", JOIN_SQL)
def _join(spark, folder):
    return orders.windowed_left_join(
        details(spark, folder), mains(spark, folder), "order_id", "oid",
        size=inputs.ORDER_WINDOW, right_ts="main_update_ms",
    )


@query(
    "lookup_by_key",
    f"""WITH {inputs.ORDERS_SQL}
    SELECT order_id, line, sku, total_money, status, uid, province
    FROM details LEFT JOIN mains ON order_id = oid""",
)
def _lookup(spark, folder):
    rows = details(spark, folder).withColumns(
        {
            "oid": F.lit(None).cast("long"),
            "total_money": F.lit(None).cast("double"),
            "status": F.lit(None).cast("int"),
            "uid": F.lit(None).cast("long"),
            "province": F.lit(None).cast("string"),
        }
    )
    filled = orders.lookup_fill(rows, order_table(spark, folder))
    return filled.select(
        "order_id", "line", "sku", "total_money", "status", "uid", "province"
    )


LATE_SQL = f"""{inputs.ORDERS_SQL},
    watermarks AS (
      SELECT *, max(update_ms) OVER (
               ORDER BY arrival, order_id, line, sku, category_id, update_ms
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
      FROM details),
    marked AS (
      SELECT *, coalesce("windowStart" + {inputs.ORDER_WINDOW_MS} <= seen - {DELAY_MS}, false)
             AS is_late
      FROM watermarks)"""
FILL_SQL = f"""WITH {LATE_SQL}
    SELECT order_id, line, sku, category_id, money, amount, update_ms, arrival,
           CASE WHEN NOT is_late THEN "windowStart" END AS "windowStart",
           j.oid, j.main_update_ms,
           coalesce(j.total_money, l.total_money) AS total_money,
           coalesce(j.status, l.status) AS status, coalesce(j.uid, l.uid) AS uid,
           coalesce(j.province, l.province) AS province,
           CASE WHEN j.oid IS NOT NULL THEN 'joined' WHEN l.oid IS NOT NULL THEN 'lookup'
                ELSE 'none' END AS main_source
    FROM marked
    LEFT JOIN mains j ON order_id = j.oid AND "windowStart" = j.main_window AND NOT is_late
    LEFT JOIN mains l ON order_id = l.oid AND j.oid IS NULL"""


@query("order_lookup_fill", FILL_SQL)
def _fill(spark, folder):
    rows = inputs.arriving_details(inputs.table(spark, folder, "lineitem"))
    return orders.match_orders(
        rows, mains(spark, folder), order_table(spark, folder), inputs.ARRIVAL,
        size=inputs.ORDER_WINDOW, delay=DELAY,
    )


# Events arrive a little shuffled; windows of six hours, one hour of patience.
LATE_SIZE, LATE_DELAY = "6 hours", "1 hour"
LATE_EVENTS_SQL = f"""{inputs.LIVE_SQL},
    arriving AS (
      SELECT id, "timestamp", (id * 7919) % 50 + id AS arrival FROM live),
    watermarks AS (
      SELECT *, max("timestamp") OVER (ORDER BY arrival, id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
      FROM arriving),
    marked AS (
      SELECT id, "timestamp", arrival,
             coalesce("timestamp" // {inputs.DAY // 4} * {inputs.DAY // 4} + {inputs.DAY // 4}
                      <= seen - 3600000, false) AS is_late
      FROM watermarks)"""


def arriving_events(raw):
    return inputs.live_events(raw).select(
        "id", "timestamp", ((F.col("id") * 7919) % 50 + F.col("id")).alias("arrival")
    )


def _split(spark, folder):
    return orders.split_late(
        arriving_events(inputs.table(spark, folder, "events")),
        order=("arrival", "id"), size=LATE_SIZE, delay=LATE_DELAY,
    )


@query(
    "late_side_output",
    f'WITH {LATE_EVENTS_SQL} SELECT id, "timestamp", arrival FROM marked WHERE is_late',
)
def _late(spark, folder):
    return _split(spark, folder)[1]


@query(
    "on_time_output",
    f'WITH {LATE_EVENTS_SQL} SELECT id, "timestamp", arrival FROM marked WHERE NOT is_late',
)
def _on_time(spark, folder):
    return _split(spark, folder)[0]


@query(
    "late_row_shape",
    f"""WITH {LATE_SQL}
    SELECT order_id, line, sku, update_ms, CAST(NULL AS BIGINT) AS oid,
           CAST(NULL AS DOUBLE) AS total_money
    FROM marked WHERE is_late""",
)
def _late_shape(spark, folder):
    columns = ["order_id", "line", "sku", "update_ms"]
    _, late = orders.split_late(
        inputs.arriving_details(inputs.table(spark, folder, "lineitem")),
        ts="update_ms", order=inputs.ARRIVAL, size=inputs.ORDER_WINDOW, delay=DELAY,
    )
    right = mains(spark, folder).select("oid", "total_money").schema
    return orders.late_row_shape(late.select(*columns), right)


@query(
    "union_joined_and_late",
    f"""WITH {LATE_SQL}
    SELECT order_id, line, sku, update_ms, oid, total_money, is_late
    FROM marked
    LEFT JOIN mains ON order_id = oid AND "windowStart" = main_window AND NOT is_late""",
)
def _union(spark, folder):
    rows = inputs.arriving_details(inputs.table(spark, folder, "lineitem"))
    on_time, late = orders.split_late(
        rows, ts="update_ms", order=inputs.ARRIVAL, size=inputs.ORDER_WINDOW, delay=DELAY
    )
    joined = orders.windowed_left_join(
        on_time.withColumn("is_late", F.lit(False)), mains(spark, folder),
        "order_id", "oid", size=inputs.ORDER_WINDOW, right_ts="main_update_ms",
    )
    both = orders.with_late_rows(joined, late.withColumn("is_late", F.lit(True)))
    return both.select(
        "order_id", "line", "sku", "update_ms", "oid", "total_money", "is_late"
    )


GROUP_SQL = f"""WITH {inputs.GROUPS_SQL}
    SELECT m.ts, m.user_id, m.group_id, m.order_id, m."windowStart",
           o.order_ts, o.order_status, o.order_amount,
           g.group_ts, g.group_status, g.group_category
    FROM members m
    LEFT JOIN group_orders o ON m.order_id = o.order_id AND m."windowStart" = o.w
    LEFT JOIN group_mains g ON m.group_id = g.group_id AND m."windowStart" = g.w"""


@query("group_buy_join", GROUP_SQL)
def _group_buy(spark, folder):
    lineitem = inputs.table(spark, folder, "lineitem")
    return orders.group_buy(
        inputs.group_details(lineitem),
        inputs.group_orders(inputs.table(spark, folder, "orders")),
        inputs.group_mains(lineitem),
        size=inputs.ORDER_WINDOW,
    )


@query(
    "tumbling_window",
    f"""WITH {inputs.ORDERS_SQL}
    SELECT "windowStart", count(*) AS details, CAST(sum(amount) AS BIGINT) AS amount
    FROM details GROUP BY ALL""",
)
def _tumbling(spark, folder):
    start = orders.tumbling_start("update_ms", inputs.ORDER_WINDOW)
    return (
        details(spark, folder)
        .groupBy(start.alias("windowStart"))
        .agg(F.count("*").alias("details"), F.sum("amount").alias("amount"))
    )
