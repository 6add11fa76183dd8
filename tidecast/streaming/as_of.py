"""Rewards and gift changes as one stream: each reward takes the version of its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import duration_ms
from ..operators.gifts import gift_points_as_of
from ..plans.as_of import validity
from ..sinks.tables import BatchWriter
from .carried import Carried

CHANGE = ("id", "name", "points", "deleted", "updateTime")
_SIDE, _IS_CHANGE = "_is_change", "_change_"


def tagged(rewards: DataFrame, changes: DataFrame) -> DataFrame:
    """Rewards and versions of gifts as the rows of one stream or table."""
    prefixed = changes.select(*[F.col(c).alias(c if c == "updateTime" else _IS_CHANGE + c) for c in changes.columns])
    return rewards.withColumn(_SIDE, F.lit(False)).unionByName(
        prefixed.withColumn(_SIDE, F.lit(True)), allowMissingColumns=True
    )


def gift_points_batches(
    path: str,
    write: BatchWriter,
    schema: T.StructType,
    rewards: Sequence[str],
    keep: str | int = "1 day",
    tie: Sequence[str] = (),
    rows_per_chunk: int | None = None,
) -> BatchWriter:
    """A ``foreachBatch`` function over :func:`tagged` rows of ``schema``.

    ``rewards`` are the columns of a reward. A batch's rewards meet its own changes and
    the versions carried from earlier ones: those in force, and those replaced no longer
    than ``keep`` before the newest change, for rewards that come late. A reward before
    a gift's oldest carried version has no points.
    """
    columns = [*CHANGE, *tie]
    fields = [
        T.StructField(c, schema[c if c == "updateTime" else _IS_CHANGE + c].dataType) for c in columns
    ]
    carried = Carried(f"{path}/versions", T.StructType(fields))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            new = batch.where(_SIDE).select(
                *[F.col(c if c == "updateTime" else _IS_CHANGE + c).alias(c) for c in columns]
            )
            known = carried.before(batch.sparkSession, batch_id).unionByName(new)
            known.persist()
            arrived = batch.where(~F.col(_SIDE)).select(*rewards)
            points = gift_points_as_of(arrived, known, tie=tie, rows_per_chunk=rows_per_chunk)
            write(points.select(*rewards, "gift_name", "points"), batch_id)
            newest = known.agg(F.max("updateTime")).first()[0]
            lives = validity(known, ["id"], "updateTime", "_until", tie)
            if newest is not None:
                oldest = newest - duration_ms(keep)
                lives = lives.where(F.col("_until").isNull() | (F.col("_until") >= oldest))
            carried.leave(lives.select(*columns), batch_id)
            known.unpersist()
        finally:
            batch.unpersist()

    return each
