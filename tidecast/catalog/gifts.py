"""Gift dimension, reward points."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters, gifts
from ..plans.as_of import validity
from ..sources.dimension import changed_since, latest_dimension
from . import inputs
from .registry import query

REWARDS_SQL = (
    inputs.LIVE_SQL
    + """,
rewards AS (SELECT * FROM live WHERE "eventId" = 'liveReward')"""
)


def rewards_of(raw):
    return gifts.reward_gifts(
        filters.rewards(inputs.live_events(raw))
    ).select("id", "anchor_id", "gift_id")


def timed_rewards_of(raw):
    rows = gifts.reward_gifts(filters.rewards(inputs.live_events(raw)))
    return rows.select("id", "timestamp", "anchor_id", "gift_id")


def rewards(spark, folder):
    return rewards_of(inputs.table(spark, folder, "events"))


def live_gifts(spark, folder):
    return latest_dimension(inputs.gift_changes(spark, folder))


@query(
    "dimension_poll",
    f"WITH {inputs.GIFTS_SQL} SELECT id, name, points, deleted FROM gifts",
)
def _poll(spark, folder):
    return live_gifts(spark, folder).drop("updateTime")


@query(
    "dimension_poll_later",
    f"""WITH {inputs.GIFTS_SQL}
    SELECT id, name, points, deleted FROM changes WHERE "updateTime" > 50""",
)
def _poll_later(spark, folder):
    changes = inputs.gift_changes(spark, folder)
    return changed_since(changes, 50).drop("updateTime")


@query(
    "filter_dimension_live",
    f"""WITH {inputs.GIFTS_SQL}
    SELECT id, name, points, deleted FROM changes WHERE deleted = 0""",
)
def _live(spark, folder):
    return changed_since(inputs.gift_changes(spark, folder)).drop("updateTime")


GIFT_POINTS_SQL = f"""WITH {REWARDS_SQL}, {inputs.GIFTS_SQL}
    SELECT r.id, r.anchor_id, r.gift_id,
           coalesce(g.name, CAST(r.gift_id AS VARCHAR)) AS gift_name,
           round(g.points, 2) AS points
    FROM rewards r LEFT JOIN gifts g ON r.gift_id = g.id"""


@query("gift_points_join", GIFT_POINTS_SQL)
def _points(spark, folder):
    found = gifts.gift_points(rewards(spark, folder), live_gifts(spark, folder))
    return found.select(
        "id", "anchor_id", "gift_id", "gift_name", F.round("points", 2).alias("points")
    )


@query(
    "gift_points_by_anchor",
    f"""WITH {REWARDS_SQL}, {inputs.GIFTS_SQL}
    SELECT r.anchor_id, round(sum(g.points), 2) AS points
    FROM rewards r LEFT JOIN gifts g ON r.gift_id = g.id GROUP BY ALL""",
)
def _points_by_anchor(spark, folder):
    summed = gifts.gift_points_by_anchor(
        rewards(spark, folder), live_gifts(spark, folder)
    )
    return summed.select("anchor_id", F.round("points", 2).alias("points"))


AS_OF_SQL = f"""WITH {REWARDS_SQL}, {inputs.VERSIONS_SQL}
    SELECT r.id, r."timestamp", r.anchor_id, r.gift_id,
           coalesce(CASE WHEN v.deleted = 0 THEN v.name END, CAST(r.gift_id AS VARCHAR)) AS gift_name,
           round(CASE WHEN v.deleted = 0 THEN v.points END, 2) AS points
    FROM rewards r ASOF LEFT JOIN versions v ON r.gift_id = v.id AND r."timestamp" >= v."updateTime" """


def shown_points(found):
    return found.select(
        "id", "timestamp", "anchor_id", "gift_id", "gift_name", F.round("points", 2).alias("points")
    )


@query("gift_points_as_of", AS_OF_SQL)
def _points_as_of(spark, folder):
    rows = timed_rewards_of(inputs.table(spark, folder, "events"))
    return shown_points(
        gifts.gift_points_as_of(rows, inputs.gift_versions(spark, folder), tie=["change"])
    )


@query(
    "dimension_validity",
    f"""WITH {inputs.VERSIONS_SQL}
    SELECT id, name, points, deleted, change, "updateTime",
           lead("updateTime") OVER (PARTITION BY id ORDER BY "updateTime") AS "validTo"
    FROM versions""",
)
def _validity(spark, folder):
    return validity(inputs.gift_versions(spark, folder), ["id"], "updateTime", tie=["change"])
