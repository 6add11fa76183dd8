"""Event predicates. Null never matches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

APP_LAUNCH = "appLaunch"
LIVE_PREFIX = "live"
LIVE_ENTER = "liveEnter"
LIVE_LEAVE = "liveLeave"
LIVE_REWARD = "liveReward"
PRODUCT_PREFIX = "product"


def filter_events(
    df: DataFrame,
    equals: str | None = None,
    prefix: str | None = None,
    isin: Iterable[str] | None = None,
    column: str = "eventId",
) -> DataFrame:
    """Keep the rows whose event name meets every given test."""
    if equals is not None:
        df = df.where(F.col(column) == equals)
    if prefix is not None:
        df = df.where(F.col(column).startswith(prefix))
    if isin is not None:
        df = df.where(F.col(column).isin(*isin))
    return df


def app_launches(events: DataFrame) -> DataFrame:
    return filter_events(events, equals=APP_LAUNCH)


def rewards(events: DataFrame) -> DataFrame:
    return filter_events(events, equals=LIVE_REWARD)


def product_events(events: DataFrame) -> DataFrame:
    """Product events with their category and product; rows lacking one are dropped."""
    return (
        filter_events(events, prefix=PRODUCT_PREFIX)
        .withColumns(
            {
                "categoryId": F.col("properties")["categoryId"],
                "productId": F.col("properties")["productId"],
            }
        )
        .where("categoryId IS NOT NULL AND productId IS NOT NULL")
    )


def room_visits(events: DataFrame) -> DataFrame:
    """Enter and leave events with the room (``anchor_id``) and ``entered`` 1 or 0.

    Rows without a room are dropped.
    """
    return (
        filter_events(events, prefix=LIVE_PREFIX, isin=(LIVE_ENTER, LIVE_LEAVE))
        .withColumns(
            {
                "anchor_id": F.col("properties")["anchor_id"],
                "entered": (F.col("eventId") == LIVE_ENTER).cast("int"),
            }
        )
        .where("anchor_id IS NOT NULL")
    )
