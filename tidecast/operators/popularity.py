"""Popularity of a room: visits that last, counted once per visitor and break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import duration_ms
from ..plans.chunks import CHUNK, ROWS_PER_CHUNK, split_chunks
from ..plans.joins import hot_keys

PAIR = ("anchor_id", "deviceId")
_FIRST, _ROW, _LAST = 0, 1, 2


def _sides(group: Sequence[str], order: Sequence[str]):
    """Windows of the rows before and after each row of a group.

    The rows after are taken in reverse order, because Spark extends a frame that
    starts at the first row but computes one that ends at the last row anew for
    every row.
    """
    grouped = Window.partitionBy(*group)
    earlier = (Window.unboundedPreceding, -1)
    before = grouped.orderBy(*order).rowsBetween(*earlier)
    after = grouped.orderBy(*[F.desc(c) for c in order]).rowsBetween(*earlier)
    return before, after


def _neighbour_leaves(moves: DataFrame, group: list[str], order: list[str]):
    """Nearest leave before and after each row of a group."""
    before, after = _sides(group, order)
    left_at = F.when(F.col("entered") == 0, F.col("timestamp"))
    return moves.withColumn("_left", left_at).withColumns(
        {"_previous": F.max("_left").over(before), "_next": F.min("_left").over(after)}
    )


def _with_leaves(moves: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Moves with ``_previous`` and ``_next`` leave of the same visitor and room."""
    order = ["timestamp", "id"]
    if moves.count() <= rows_per_chunk:
        return _neighbour_leaves(moves, list(PAIR), order)
    hot = hot_keys(moves, PAIR, rows_per_chunk)
    if hot.isEmpty():
        return _neighbour_leaves(moves, list(PAIR), order)

    # Only visitors with very many moves are cut along time. There are at most
    # rows / rows_per_chunk of them.
    hot = hot.select(*[F.col(c).alias(f"_{c}") for c in PAIR])
    same = F.lit(True)
    for c in PAIR:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    rest = moves.join(hot, same, "left_anti")
    busy = moves.join(hot, same, "left_semi")
    chunked = split_chunks(busy, order, rows_per_chunk)
    busy = busy.withColumn(CHUNK, F.lit(0)) if chunked is None else chunked
    left_at = F.when(F.col("entered") == 0, F.col("timestamp"))
    before, after = _sides(PAIR, [CHUNK])
    known = (
        busy.groupBy(*PAIR, CHUNK)
        .agg(F.min(left_at).alias("_earliest"), F.max(left_at).alias("_latest"))
        .withColumns(
            {
                "_in": F.max("_latest").over(before),
                "_out": F.min("_earliest").over(after),
            }
        )
    )
    # They enter the chunk as leaves before its first and after its last row.
    edges = [
        known.where(F.col(source).isNotNull()).select(
            *PAIR,
            CHUNK,
            F.col(source).alias("timestamp"),
            F.lit(None).cast(moves.schema["id"].dataType).alias("id"),
            F.lit(0).alias("entered"),
            F.lit(place).alias("_place"),
        )
        for source, place in (("_in", _FIRST), ("_out", _LAST))
    ]
    placed = busy.withColumn("_place", F.lit(_ROW))
    for edge in edges:
        placed = placed.unionByName(edge)
    found = _neighbour_leaves(placed, [*PAIR, CHUNK], ["_place", *order])
    found = found.where(F.col("_place") == _ROW).drop("_place", CHUNK)
    return _neighbour_leaves(rest, list(PAIR), order).unionByName(found)


def popular_entries(
    visits: DataFrame,
    min_stay: str | int = "60 seconds",
    revisit_gap: str | int = "30 minutes",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """The enters that count.

    An enter counts when the visitor does not leave within ``min_stay`` and had
    not left that room within the ``revisit_gap`` before it.
    """
    moves = visits.select(*PAIR, "timestamp", "id", "entered")
    found = _with_leaves(moves, rows_per_chunk or ROWS_PER_CHUNK)
    t = F.col("timestamp")
    stayed = F.col("_next").isNull() | (F.col("_next") - t >= duration_ms(min_stay))
    returned = F.col("_previous").isNull() | (
        t - F.col("_previous") > duration_ms(revisit_gap)
    )
    return found.where((F.col("entered") == 1) & stayed & returned).select(
        *PAIR, "timestamp", "id"
    )


def popularity(
    visits: DataFrame,
    min_stay: str | int = "60 seconds",
    revisit_gap: str | int = "30 minutes",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Counted enters per room."""
    entries = popular_entries(visits, min_stay, revisit_gap, rows_per_chunk)
    return entries.groupBy("anchor_id").agg(F.count("*").alias("popularity"))
