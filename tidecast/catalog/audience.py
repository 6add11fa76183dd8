"""Audience and popularity of rooms."""

from __future__ import annotations

from ..operators import filters
from ..operators.audience import audience, audience_snapshot, visit_detail
from ..operators.popularity import popularity
from . import inputs
from .registry import query


def visits(spark, folder):
    return filters.room_visits(
        inputs.live_events(inputs.table(spark, folder, "events"))
    )


STEPS_SQL = (
    inputs.VISITS_SQL
    + """,
firsts AS (
  SELECT *, CASE WHEN entered = 1 AND row_number() OVER (
                   PARTITION BY anchor_id, "deviceId", entered ORDER BY "timestamp", id) = 1
            THEN 1 ELSE 0 END AS first_visit
  FROM visits),
running AS (
  SELECT id, "timestamp", anchor_id, CAST(sum(first_visit) OVER w AS BIGINT) AS uv,
         CAST(sum(entered) OVER w AS BIGINT) AS pv,
         CAST(sum(2 * entered - 1) OVER w AS BIGINT) AS s
  FROM firsts
  WINDOW w AS (PARTITION BY anchor_id ORDER BY "timestamp", id ROWS UNBOUNDED PRECEDING)),
floored AS (
  SELECT id, "timestamp", anchor_id, uv, pv,
         s - least(0, min(s) OVER (PARTITION BY anchor_id ORDER BY "timestamp", id
                                   ROWS UNBOUNDED PRECEDING)) AS online
  FROM running)"""
)

AUDIENCE_SQL = f"""WITH {STEPS_SQL}
    SELECT id, "timestamp", anchor_id, uv, pv, online FROM floored"""


@query("audience_uv_pv_online", AUDIENCE_SQL)
def _audience(spark, folder):
    return audience(visits(spark, folder))


@query(
    "audience_unfloored",
    f"""WITH {STEPS_SQL}
    SELECT id, "timestamp", anchor_id, uv, pv, s AS online FROM running""",
)
def _audience_unfloored(spark, folder):
    return audience(visits(spark, folder), floor_at_zero=False)


def _final_sql(source: str, online: str) -> str:
    return f"""WITH {STEPS_SQL}
    SELECT anchor_id, uv, pv, online FROM (
      SELECT anchor_id, uv, pv, {online} AS online,
             row_number() OVER (PARTITION BY anchor_id ORDER BY "timestamp" DESC, id DESC) AS r
      FROM {source}) WHERE r = 1"""


@query("audience_final", _final_sql("floored", "online"))
def _audience_final(spark, folder):
    return audience(visits(spark, folder), mode="final")


@query("audience_final_unfloored", _final_sql("running", "s"))
def _audience_final_unfloored(spark, folder):
    return audience(visits(spark, folder), floor_at_zero=False, mode="final")


def _snapshot_sql(source: str, online: str, width: int) -> str:
    return f"""WITH {STEPS_SQL},
    buckets AS (
      SELECT *, {online} AS o, "timestamp" // {width} * {width} AS bucket_start,
             row_number() OVER (PARTITION BY anchor_id, "timestamp" // {width}
                                ORDER BY "timestamp" DESC, id DESC) AS r
      FROM {source})
    SELECT anchor_id || '_' || strftime(make_timestamp(bucket_start * 1000), '%Y%m%d')
             AS anchor_date,
           anchor_id, bucket_start, uv, pv, o AS online
    FROM buckets WHERE r = 1"""


@query("audience_snapshot_10s", _snapshot_sql("running", "s", 10_000))
def _snapshot(spark, folder):
    return audience_snapshot(visits(spark, folder))


@query("audience_snapshot_6h", _snapshot_sql("running", "s", inputs.DAY // 4))
def _snapshot_6h(spark, folder):
    return audience_snapshot(visits(spark, folder), every="6 hours")


@query("audience_snapshot_floored", _snapshot_sql("floored", "online", inputs.DAY // 4))
def _snapshot_floored(spark, folder):
    return audience_snapshot(
        visits(spark, folder), every="6 hours", floor_at_zero=True
    )


@query(
    "audience_visit_detail",
    f"""WITH {inputs.VISITS_SQL}
    SELECT id, anchor_id, "deviceId", "eventId",
           strftime(make_timestamp("timestamp" * 1000), '%Y%m%d') AS date,
           strftime(make_timestamp("timestamp" * 1000), '%H') AS hour
    FROM visits""",
)
def _visit_detail(spark, folder):
    return visit_detail(visits(spark, folder)).select(
        "id", "anchor_id", "deviceId", "eventId", "date", "hour"
    )


def entries_sql(min_stay: int, gap: int) -> str:
    return f"""{inputs.VISITS_SQL},
    sides AS (
      SELECT *, max(CASE WHEN entered = 0 THEN "timestamp" END) OVER (
                  PARTITION BY anchor_id, "deviceId" ORDER BY "timestamp", id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p,
             min(CASE WHEN entered = 0 THEN "timestamp" END) OVER (
                  PARTITION BY anchor_id, "deviceId" ORDER BY "timestamp", id
                  ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n
      FROM visits),
    entries AS (
      SELECT anchor_id, "deviceId", "timestamp", id FROM sides
      WHERE entered = 1 AND (n IS NULL OR n - "timestamp" >= {min_stay})
        AND (p IS NULL OR "timestamp" - p > {gap}))"""


def _popularity_sql(min_stay: int, gap: int) -> str:
    return f"""WITH {entries_sql(min_stay, gap)}
    SELECT anchor_id, count(*) AS popularity FROM entries GROUP BY ALL"""


@query("popularity", _popularity_sql(60_000, 1_800_000))
def _popularity(spark, folder):
    return popularity(visits(spark, folder))


@query("popularity_long_stay", _popularity_sql(inputs.DAY // 4, 3 * inputs.DAY))
def _popularity_long(spark, folder):
    return popularity(visits(spark, folder), "6 hours", "3 days")
