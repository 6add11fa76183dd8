"""Users: counts, first-seen flags, activity visits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters, users
from ..operators.location import enrich_location
from ..operators.totals import running_sum
from . import inputs
from .registry import query

LAUNCHES_SQL = (
    inputs.LIVE_SQL
    + """,
launches AS (SELECT * FROM live WHERE "eventId" = 'appLaunch')"""
)


def launches(spark, folder):
    return filters.app_launches(
        inputs.live_events(inputs.table(spark, folder, "events"))
    )


@query(
    "users_by_device_type",
    f"""WITH {LAUNCHES_SQL}
    SELECT "deviceType", "isNew", count(*) AS users FROM launches GROUP BY ALL""",
)
def _by_device_type(spark, folder):
    return users.count_users(launches(spark, folder), ["deviceType", "isNew"])


@query(
    "users_by_device_type_running",
    f"""WITH {LAUNCHES_SQL}
    SELECT id, "timestamp", "deviceType", "isNew",
           count(*) OVER (PARTITION BY "deviceType", "isNew" ORDER BY "timestamp", id
                          ROWS UNBOUNDED PRECEDING) AS users
    FROM launches""",
)
def _by_device_type_running(spark, folder):
    return users.count_users(
        launches(spark, folder), ["deviceType", "isNew"], mode="running"
    )


@query(
    "users_total_by_is_new",
    f"""WITH {LAUNCHES_SQL}
    SELECT "isNew", count(*) AS users FROM launches GROUP BY ALL""",
)
def _total(spark, folder):
    return users.total_users(_by_device_type(spark, folder))


@query(
    "users_total_by_is_new_literal",
    f"""WITH {LAUNCHES_SQL},
    counts AS (SELECT "deviceType", "isNew", count(*) AS n FROM launches GROUP BY ALL)
    SELECT "isNew", CAST(sum(n * (n + 1) // 2) AS BIGINT) AS users
    FROM counts GROUP BY ALL""",
)
def _total_literal(spark, folder):
    return users.total_users(_by_device_type(spark, folder), literal=True)


@query(
    "users_by_province",
    f"""WITH {LAUNCHES_SQL}, {inputs.REGIONS_SQL}
    SELECT province, "isNew", count(*) AS users
    FROM launches LEFT JOIN regions
      ON longitude >= lon_min AND longitude < lon_max
     AND latitude >= lat_min AND latitude < lat_max
    GROUP BY ALL""",
)
def _by_province(spark, folder):
    placed = enrich_location(launches(spark, folder), inputs.regions(spark, folder))
    return users.count_users(placed, ["province", "isNew"])


@query(
    "users_by_province_running",
    f"""WITH {LAUNCHES_SQL}, {inputs.REGIONS_SQL}
    SELECT id, "timestamp", province, "isNew",
           count(*) OVER (PARTITION BY province, "isNew" ORDER BY "timestamp", id
                          ROWS UNBOUNDED PRECEDING) AS users
    FROM launches LEFT JOIN regions
      ON longitude >= lon_min AND longitude < lon_max
     AND latitude >= lat_min AND latitude < lat_max""",
)
def _by_province_running(spark, folder):
    placed = enrich_location(launches(spark, folder), inputs.regions(spark, folder))
    return users.count_users(placed, ["province", "isNew"], mode="running")


IS_NEW_SQL = f"""WITH {LAUNCHES_SQL}
    SELECT id, "timestamp", "deviceId", "deviceType",
           CAST(CASE WHEN row_number() OVER (PARTITION BY "deviceType", "deviceId"
                          ORDER BY "timestamp", id) = 1 THEN 1 ELSE 0 END AS INTEGER) AS "isN"
    FROM launches"""


@query("is_new_user_by_device_type", IS_NEW_SQL)
def _is_new(spark, folder):
    rows = launches(spark, folder).select("id", "timestamp", "deviceId", "deviceType")
    return users.flag_first_seen(rows)


COUNT_NEW_SQL = f"""WITH {LAUNCHES_SQL},
    flagged AS (
      SELECT id, "timestamp", "deviceId", "releaseChannel",
             CASE WHEN row_number() OVER (PARTITION BY "deviceId" ORDER BY "timestamp", id) = 1
                  THEN 1 ELSE 0 END AS is_n
      FROM launches)
    SELECT id, "timestamp", "deviceId", "releaseChannel", CAST(is_n AS INTEGER) AS "isN",
           CAST(CASE WHEN is_n = 1 THEN
             sum(is_n) OVER (PARTITION BY "releaseChannel" ORDER BY "timestamp", id
                             ROWS UNBOUNDED PRECEDING) ELSE 0 END AS INTEGER) AS "perCnt"
    FROM flagged"""


@query("new_user_count_by_channel", COUNT_NEW_SQL)
def _count_new(spark, folder):
    rows = launches(spark, folder).select(
        "id", "timestamp", "deviceId", "releaseChannel"
    )
    return users.count_first_seen(rows)


# Activity rows: the user, one of four activities, and the kind of event.
ACTIVITY_SQL = """
activity_rows AS (
  SELECT event_id AS id, (epoch_us(ts) // 1000) AS "timestamp", CAST(user_id AS VARCHAR) AS uid,
         'A' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 4) AS activity,
         event_type AS event
  FROM events)"""


def activity_rows(spark, folder):
    return activity_rows_of(inputs.table(spark, folder, "events"))


def activity_rows_of(raw):
    k = F.get_json_object("props", "$.k").cast("int")
    return raw.select(
        F.col("event_id").alias("id"),
        inputs.millis("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("uid"),
        F.concat(F.lit("A"), k % 4).alias("activity"),
        F.col("event_type").alias("event"),
    )


@query(
    "activity_pv_uv_exact",
    f"""WITH {ACTIVITY_SQL}
    SELECT activity, event, count(DISTINCT uid) AS uv, count(*) AS pv
    FROM activity_rows GROUP BY ALL""",
)
def _pv_uv(spark, folder):
    return users.pv_uv(activity_rows(spark, folder))


@query(
    "activity_pv_uv_running",
    f"""WITH {ACTIVITY_SQL},
    firsts AS (
      SELECT *, CASE WHEN row_number() OVER (PARTITION BY activity, event, uid
                       ORDER BY "timestamp", id) = 1 THEN 1 ELSE 0 END AS f
      FROM activity_rows)
    SELECT "timestamp", id, activity, event, CAST(sum(f) OVER w AS BIGINT) AS uv,
           count(*) OVER w AS pv
    FROM firsts
    WINDOW w AS (PARTITION BY activity, event ORDER BY "timestamp", id
                 ROWS UNBOUNDED PRECEDING)""",
)
def _pv_uv_running(spark, folder):
    return users.pv_uv(activity_rows(spark, folder), mode="running")


# As many visitors as a table of the test size has are counted exactly by a sketch.
PV_UV_SQL = f"""WITH {ACTIVITY_SQL}
    SELECT activity, event, count(DISTINCT uid) AS uv, count(*) AS pv
    FROM activity_rows GROUP BY ALL"""


@query("activity_pv_uv_approx", PV_UV_SQL)
def _pv_uv_approx(spark, folder):
    """Estimated visitors, from a sketch per key."""
    return users.sketched_pv_uv(users.visit_sketches(activity_rows(spark, folder)))


# Category rows: parts sold, by brand-like category.
CATEGORY_SQL = """
category_rows AS (
  SELECT event_id AS id, (epoch_us(ts) // 1000) AS "timestamp",
         'c' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 10) AS category,
         CAST(floor(value) AS BIGINT) AS quantity
  FROM events)"""


def category_rows(raw):
    k = F.get_json_object("props", "$.k").cast("int")
    return raw.select(
        F.col("event_id").alias("id"),
        inputs.millis("ts").alias("timestamp"),
        F.concat(F.lit("c"), k % 10).alias("category"),
        F.floor("value").alias("quantity"),
    )


RUNNING_SUM_SQL = f"""WITH {CATEGORY_SQL}
    SELECT category, "timestamp", id,
           CAST(sum(quantity) OVER (PARTITION BY category ORDER BY "timestamp", id
                                    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
    FROM category_rows"""


@query("category_running_sum", RUNNING_SUM_SQL)
def _running_sum(spark, folder):
    rows = category_rows(inputs.table(spark, folder, "events"))
    return running_sum(rows).select("category", "timestamp", "id", "total")


@query(
    "category_sum",
    f"""WITH {CATEGORY_SQL}
    SELECT category, CAST(sum(quantity) AS BIGINT) AS total
    FROM category_rows GROUP BY ALL""",
)
def _sum(spark, folder):
    rows = category_rows(inputs.table(spark, folder, "events"))
    return running_sum(rows, mode="final")
