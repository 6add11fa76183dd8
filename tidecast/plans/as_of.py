"""The version of a key that is in force at a row's time, by one merge in order of time.

A join on the key with a time condition would meet every row of a key with every version
of it. Here rows and versions are merged by key and time, and each row takes the version
last seen before it. Keys with very many rows or versions are cut along the time: each
(key, chunk) is merged alone and starts with the version that earlier chunks ended on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunks import CHUNK, split_chunks

_AT, _SIDE, _SEEN = "_at", "_side", "_seen"
#: Order of what happens at one instant: what was carried in, changes, rows.
_CARRIED, _VERSION, _ROW = 0, 1, 2


def _no_value(column: Column, like: DataFrame, name: str) -> Column:
    return F.lit(None).cast(like.select(column.alias(name)).schema[name].dataType)


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    since: str,
    values: Sequence[str],
    tie: Sequence[str] = (),
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """``rows`` with ``values`` and ``since`` of the newest version at or before ``at``.

    Keys have one name on both sides and ``at`` and ``since`` are numbers or times of one
    kind. Of versions of one key and instant the last in ``tie`` order stands. Rows
    before a key's first version, without a key or without a time have nulls. Every row
    comes out once; the version's columns must not clash with the row's.
    """
    taken = [c for c in (*values, since) if c in rows.columns]
    if taken:
        raise ValueError(f"rows already have {', '.join(taken)}")
    known = versions
    for name in (*keys, since):
        known = known.where(F.col(name).isNotNull())
    version = F.struct(*values, since)
    order = F.struct(F.lit(0).alias("_"), *tie)
    steps = rows.select(
        *keys, F.col(at).alias(_AT), F.lit(_ROW).alias(_SIDE), F.struct("*").alias("_row"),
        _no_value(order, versions, "_tie").alias("_tie"), _no_value(version, versions, _SEEN).alias(_SEEN),
    ).unionByName(
        known.select(
            *keys, F.col(since).alias(_AT), F.lit(_VERSION).alias(_SIDE),
            _no_value(F.struct("*"), rows, "_row").alias("_row"),
            order.alias("_tie"), version.alias(_SEEN),
        )
    )
    chunked = split_chunks(
        steps, [_AT], rows_per_chunk, rows.select(F.col(at).alias(_AT))
    )
    within = list(keys)
    if chunked is not None:
        within.append(CHUNK)
        last = F.max_by(_SEEN, F.when(F.col(_SIDE) == _VERSION, F.struct(_AT, "_tie")))
        ends = chunked.groupBy(*within).agg(last.alias(_SEEN))
        before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select(*within, F.last(_SEEN, ignorenulls=True).over(before).alias(_SEEN))
        steps = chunked.unionByName(
            carried.where(F.col(_SEEN).isNotNull()).withColumn(_SIDE, F.lit(_CARRIED)),
            allowMissingColumns=True,
        )
    # Carried versions have no time, and nulls come first.
    merge = Window.partitionBy(*within).orderBy(F.asc_nulls_first(_AT), _SIDE, "_tie").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    in_force = F.when(F.col(_AT).isNotNull(), F.last(_SEEN, ignorenulls=True).over(merge))
    merged = steps.withColumn(_SEEN, in_force).where(F.col(_SIDE) == _ROW)
    return merged.select("_row.*", f"{_SEEN}.*")


def validity(
    versions: DataFrame,
    keys: Sequence[str],
    since: str,
    until: str = "validTo",
    tie: Sequence[str] = (),
) -> DataFrame:
    """``versions`` with the instant at which the key's next version replaces each.

    The last version of a key has a null there. Of versions of one instant the last in
    ``tie`` order stands.
    """
    newest = Window.partitionBy(*keys, since).orderBy(*[F.desc(c) for c in tie] or [F.lit(0)])
    one = versions.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
    following = Window.partitionBy(*keys).orderBy(since)
    return one.withColumn(until, F.lead(since).over(following))
