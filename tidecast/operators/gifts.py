"""Gift points of hosts, with gifts kept in a changing dimension table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.as_of import as_of_join
from ..plans.joins import left_join


def reward_gifts(reward_events: DataFrame) -> DataFrame:
    """Room and gift number of each reward; rows lacking one are dropped."""
    return reward_events.withColumns(
        {
            "anchor_id": F.col("properties")["anchor_id"],
            "gift_id": F.col("properties")["gift_id"].try_cast("int"),
        }
    ).where("anchor_id IS NOT NULL AND gift_id IS NOT NULL")


def _gift_table(gifts: DataFrame, *more) -> DataFrame:
    return gifts.select(
        F.col("id").cast("int").alias("gift_id"),
        F.col("name").alias("_name"),
        F.col("points"),
        *more,
    )


def gift_points(rewards: DataFrame, gifts: DataFrame) -> DataFrame:
    """Each reward with its gift's name and points.

    An unknown gift keeps its number as the name and has no points.
    """
    found = left_join(rewards, _gift_table(gifts), ["gift_id"])
    return found.withColumn(
        "gift_name", F.coalesce("_name", F.col("gift_id").cast("string"))
    ).drop("_name")


def gift_points_as_of(
    rewards: DataFrame,
    changes: DataFrame,
    updated: str = "updateTime",
    at: str = "timestamp",
    tie: Sequence[str] = (),
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Each reward with its gift's name and points as they were at the reward's time.

    ``changes`` are all versions of the gifts (``id, name, points, deleted`` and the time
    of the change). A gift that is unknown, not yet there or deleted at that time keeps
    its number as the name and has no points; one that comes back counts again.
    """
    versions = _gift_table(changes, "deleted", F.col(updated).alias("_since"), *tie)
    found = as_of_join(
        rewards, versions, ["gift_id"], at, "_since", ["_name", "points", "deleted"], tie, rows_per_chunk
    )
    live = F.col("deleted") == 0
    return found.withColumns(
        {
            "gift_name": F.coalesce(F.when(live, F.col("_name")), F.col("gift_id").cast("string")),
            "points": F.when(live, F.col("points")),
        }
    ).drop("_name", "deleted", "_since")


def points_by(
    df: DataFrame, keys: Sequence[str] = ("anchor_id",), points: str = "points"
) -> DataFrame:
    """Sum of points per key, ignoring rows without points."""
    return df.groupBy(*keys).agg(F.sum(points).alias("points"))


def gift_points_by_anchor(rewards: DataFrame, gifts: DataFrame) -> DataFrame:
    """Points per room. Rewards are counted per room and gift before the join."""
    counted = rewards.groupBy("anchor_id", "gift_id").agg(F.count("*").alias("_n"))
    found = left_join(counted, _gift_table(gifts), ["gift_id"])
    return points_by(found.withColumn("points", F.col("points") * F.col("_n")))
