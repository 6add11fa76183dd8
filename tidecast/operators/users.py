"""New and returning users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.chunks import running_sums

ORDER = ("timestamp", "id")


def count_users(
    launches: DataFrame,
    keys: Sequence[str],
    mode: str = "final",
    order: Sequence[str] = ORDER,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Launches per key: one row per key, or one updated row per launch (``running``).

    A null key is a group of its own.
    """
    if mode == "final":
        return launches.groupBy(*keys).agg(F.count("*").alias("users"))
    rows = launches.select(*keys, *order)
    return running_sums(rows, keys, order, {"users": F.lit(1)}, rows_per_chunk)


def total_users(
    counts: DataFrame, key: str = "isNew", literal: bool = False
) -> DataFrame:
    """Second-level total of :func:`count_users` (``final``).

    ``literal`` sums every intermediate count instead, so that a group of n
    launches adds 1 + 2 + ... + n.
    """
    users = F.col("users")
    term = (users * (users + 1) / 2).cast("long") if literal else users
    return counts.groupBy(key).agg(F.sum(term).alias("users"))


def _first_rows(
    df: DataFrame, user: str, scope: Sequence[str], order: Sequence[str], *extra: str
) -> DataFrame:
    # Aggregated before the shuffle, so a busy device costs one row per task.
    first = F.min(F.struct(*order, *extra)).alias("_first")
    return df.groupBy(*scope, user).agg(first).select("_first.*")


def flag_first_seen(
    df: DataFrame,
    user: str = "deviceId",
    scope: Sequence[str] = ("deviceType",),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Every row, with ``isN`` 1 on a user's first row within the scope and 0 elsewhere.

    The last column of ``order`` must identify the row. The flag is joined on
    it, so the join spreads evenly even if one user has most of the rows.
    """
    row_id = order[-1]
    first = _first_rows(df, user, scope, order).select(row_id, F.lit(1).alias("isN"))
    return (
        df.drop("isN")
        .join(first, row_id, "left")
        .withColumn("isN", F.coalesce("isN", F.lit(0)))
    )


def count_first_seen(
    df: DataFrame,
    user: str = "deviceId",
    key: str = "releaseChannel",
    order: Sequence[str] = ORDER,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Every row with ``isN`` (first seen over all rows) and ``perCnt``.

    ``perCnt`` counts a key's new users so far on the rows that are new, and is
    0 on the others.
    """
    row_id = order[-1]
    first = _first_rows(df, user, (), order, key)
    counted = running_sums(
        first, [key], order, {"perCnt": F.lit(1).cast("int")}, rows_per_chunk, df
    ).select(row_id, F.lit(1).alias("isN"), F.col("perCnt").cast("int").alias("perCnt"))
    return (
        df.drop("isN", "perCnt")
        .join(counted, row_id, "left")
        .withColumns(
            {c: F.coalesce(c, F.lit(0)) for c in ("isN", "perCnt")}
        )
    )


#: Up to 3/4 * 2^(SKETCH_SIZE - 3) visitors a sketch keeps them all and is exact.
SKETCH_SIZE = 14


def visit_sketches(
    df: DataFrame, keys: Sequence[str] = ("activity", "event"), user: str = "uid"
) -> DataFrame:
    """``pv`` and a sketch of the visitors per key, which :func:`sketched_pv_uv` adds up."""
    return df.groupBy(*keys).agg(
        F.hll_sketch_agg(user, SKETCH_SIZE).alias("sketch"), F.count("*").alias("pv")
    )


def sketched_pv_uv(sketches: DataFrame, keys: Sequence[str] = ("activity", "event")) -> DataFrame:
    """Visits and estimated distinct visitors per key, from sketches of any number of parts.

    Beyond the visitors that a sketch keeps, the estimate is off by 1 % or so.
    """
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("uv"), F.sum("pv").alias("pv")
    )


def pv_uv(
    df: DataFrame,
    keys: Sequence[str] = ("activity", "event"),
    user: str = "uid",
    mode: str = "final",
    order: Sequence[str] = ORDER,
    approx: bool = False,
    rsd: float = 0.03,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Visits and distinct visitors per key; ``running`` gives one row per input row."""
    if mode == "final":
        uv = (
            F.approx_count_distinct(user, rsd) if approx else F.count_distinct(user)
        )
        return df.groupBy(*keys).agg(uv.alias("uv"), F.count("*").alias("pv"))
    steps = df.select(
        *keys, *order, F.lit(1).alias("_row"), F.lit(1).alias("pv"), F.lit(0).alias("uv")
    )
    first = (
        df.where(F.col(user).isNotNull())
        .groupBy(*keys, user)
        .agg(F.min(F.struct(*order)).alias("_first"))
        .select(
            *keys,
            "_first.*",
            F.lit(0).alias("_row"),
            F.lit(0).alias("pv"),
            F.lit(1).alias("uv"),
        )
    )
    sums = {"uv": F.col("uv"), "pv": F.col("pv")}
    counted = running_sums(
        steps.unionByName(first), keys, [*order, "_row"], sums, rows_per_chunk, df
    )
    return counted.where("_row = 1").select(*order, *keys, "uv", "pv")
