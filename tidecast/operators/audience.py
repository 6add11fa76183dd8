"""Visitors, visits and people present per room."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import date_text, duration_ms, floor_ms, hour_text, join_text
from ..plans.chunks import running_floored_sums, running_sums


def _increments(visits: DataFrame) -> DataFrame:
    """What each visit adds, plus one extra row where a device first enters a room.

    The extra rows stand right before the visit they belong to. That way a first
    visit needs no join back to the detail, which one busy device would skew.
    """
    steps = visits.select(
        "anchor_id",
        "timestamp",
        "id",
        F.lit(1).alias("_visit"),
        F.col("entered").cast("long").alias("pv"),
        F.lit(0).cast("long").alias("uv"),
        (2 * F.col("entered") - 1).cast("long").alias("online"),
    )
    first = (
        visits.where("entered = 1")
        .groupBy("anchor_id", "deviceId")
        .agg(F.min(F.struct("timestamp", "id")).alias("_first"))
        .select(
            "anchor_id",
            "_first.timestamp",
            "_first.id",
            F.lit(0).alias("_visit"),
            F.lit(0).cast("long").alias("pv"),
            F.lit(1).cast("long").alias("uv"),
            F.lit(0).cast("long").alias("online"),
        )
    )
    return steps.unionByName(first)


def flagged_increments(visits: DataFrame) -> DataFrame:
    """What each visit adds, for visits whose ``isN`` marks a device's first enter."""
    return visits.where("anchor_id IS NOT NULL").select(
        "anchor_id",
        "timestamp",
        "id",
        (F.col("entered") * F.col("isN")).cast("long").alias("uv"),
        F.col("entered").cast("long").alias("pv"),
        (2 * F.col("entered") - 1).cast("long").alias("online"),
    )


def audience(
    visits: DataFrame,
    floor_at_zero: bool = True,
    mode: str = "running",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Per visit (``running``) or per room (``final``): uv, pv and people online.

    Takes the rows of :func:`filters.room_visits`. Entering adds a visit and a
    person online; leaving takes a person away, not below zero when
    ``floor_at_zero``.
    """
    visits = visits.where("anchor_id IS NOT NULL")
    if mode == "final" and not floor_at_zero:
        return visits.groupBy("anchor_id").agg(
            F.countDistinct(
                F.when(F.col("entered") == 1, F.struct("deviceId"))
            ).alias("uv"),
            F.sum("entered").cast("long").alias("pv"),
            F.sum(2 * F.col("entered") - 1).cast("long").alias("online"),
        )
    steps = _increments(visits)
    keys, order = ["anchor_id"], ["timestamp", "id", "_visit"]
    sums = {name: F.col(name) for name in ("uv", "pv", "online")}
    if floor_at_zero:
        counted = running_floored_sums(
            steps, keys, order, sums, "online", rows_per_chunk, visits
        )
    else:
        counted = running_sums(steps, keys, order, sums, rows_per_chunk, visits)
    rows = counted.where("_visit = 1").select(
        "id", "timestamp", "anchor_id", "uv", "pv", "online"
    )
    if mode == "running":
        return rows
    last = F.max(F.struct("timestamp", "id", "uv", "pv", "online"))
    return (
        rows.groupBy("anchor_id")
        .agg(last.alias("_last"))
        .select("anchor_id", "_last.uv", "_last.pv", "_last.online")
    )


def audience_snapshot(
    visits: DataFrame,
    every: str | int = "10 seconds",
    floor_at_zero: bool = False,
    tz: str | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """State of each room at the end of every interval that saw a visit.

    Without the floor the rows are summed per room and interval first, so only
    those sums are ordered. With it the running rows are needed.
    """
    visits = visits.where("anchor_id IS NOT NULL")
    bucket = floor_ms("timestamp", duration_ms(every))
    if floor_at_zero:
        last = F.max(F.struct("timestamp", "id", "uv", "pv", "online"))
        states = (
            audience(visits, True, "running", rows_per_chunk)
            .groupBy("anchor_id", bucket.alias("bucket_start"))
            .agg(last.alias("_last"))
            .select(
                "anchor_id", "bucket_start", "_last.uv", "_last.pv", "_last.online"
            )
        )
    else:
        moves = visits.groupBy("anchor_id", bucket.alias("bucket_start")).agg(
            F.sum("entered").cast("long").alias("pv"),
            F.sum(2 * F.col("entered") - 1).cast("long").alias("online"),
        )
        newcomers = (
            visits.where("entered = 1")
            .groupBy("anchor_id", "deviceId")
            .agg(F.min("timestamp").alias("timestamp"))
            .groupBy("anchor_id", bucket.alias("bucket_start"))
            .agg(F.count("*").alias("uv"))
        )
        summed = (
            moves.withColumn("uv", F.lit(0).cast("long"))
            .unionByName(newcomers, allowMissingColumns=True)
            .groupBy("anchor_id", "bucket_start")
            .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("uv", "pv", "online")])
        )
        states = _states(summed)
    return _keyed(states, tz)


def _states(increments: DataFrame) -> DataFrame:
    """Totals at the end of each interval from what each interval added."""
    here = (
        Window.partitionBy("anchor_id")
        .orderBy("bucket_start")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return increments.withColumns(
        {c: F.sum(c).over(here) for c in ("uv", "pv", "online")}
    )


def _keyed(states: DataFrame, tz: str | None) -> DataFrame:
    return states.select(
        join_text("_", "anchor_id", date_text("bucket_start", tz)).alias("anchor_date"),
        "anchor_id",
        "bucket_start",
        "uv",
        "pv",
        "online",
    )


def snapshot_increments(
    flagged: DataFrame, every: str | int = "10 seconds"
) -> DataFrame:
    """What visits add per room and interval.

    ``flagged`` are visits whose ``isN`` marks a device's first enter of the
    room. The increments of different batches of visits add up.
    """
    bucket = floor_ms("timestamp", duration_ms(every))
    return flagged.groupBy("anchor_id", bucket.alias("bucket_start")).agg(
        F.sum(F.col("entered") * F.col("isN")).cast("long").alias("uv"),
        F.sum("entered").cast("long").alias("pv"),
        F.sum(2 * F.col("entered") - 1).cast("long").alias("online"),
    )


def snapshot_from_increments(
    increments: DataFrame, tz: str | None = None
) -> DataFrame:
    """Like :func:`audience_snapshot`, from the increments of all batches so far."""
    summed = increments.groupBy("anchor_id", "bucket_start").agg(
        *[F.sum(c).alias(c) for c in ("uv", "pv", "online")]
    )
    return _keyed(_states(summed), tz)


def visit_detail(visits: DataFrame, tz: str | None = None) -> DataFrame:
    """The visits themselves with date and hour, as kept in the detail table."""
    return visits.withColumns(
        {"date": date_text("timestamp", tz), "hour": hour_text("timestamp", tz)}
    )

