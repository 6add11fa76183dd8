"""Matching of order details, orders and group purchases in event-time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import duration_ms, event_time, floor_ms
from ..plans.chunks import running_max_before
from ..plans.joins import left_join

WINDOW_START = "windowStart"


def tumbling_start(ms: str | Column, size: str | int) -> Column:
    """Start, in ms, of the tumbling window that holds the instant."""
    return floor_ms(ms, duration_ms(size))


def _in_window(df: DataFrame, ts: str, size: str | int, delay: str | int) -> DataFrame:
    if not df.isStreaming:
        return df.withColumn(WINDOW_START, tumbling_start(ts, size))
    width = duration_ms(size)
    return (
        df.withColumn("_ts", event_time(ts))
        .withWatermark("_ts", f"{duration_ms(delay)} milliseconds")
        .withColumn(WINDOW_START, F.window("_ts", f"{width} milliseconds"))
        .drop("_ts")
    )


def _start_ms(joined: DataFrame) -> DataFrame:
    """The window as its start in ms, on streams as on batches."""
    if not joined.isStreaming:
        return joined
    return joined.withColumn(WINDOW_START, F.unix_millis(f"{WINDOW_START}.start"))


def windowed_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    size: str | int = "5 seconds",
    delay: str | int = "2 seconds",
    left_ts: str = "update_ms",
    right_ts: str = "update_ms",
) -> DataFrame:
    """Every pair with the same key and tumbling window; lone left rows are kept.

    The right side's columns must not clash with the left's, but for its time
    column. Lone left rows have nulls there. On streams a lone row appears once
    the watermark has passed its window.
    """
    if left_ts in right.columns:
        raise ValueError(f"right side repeats the left time column {left_ts}")
    l = _in_window(left, left_ts, size, delay)
    r = _in_window(right, right_ts, size, delay).withColumn(left_key, F.col(right_key))
    return _start_ms(left_join(l, r, [left_key, WINDOW_START]))


def mark_late(
    df: DataFrame,
    ts: str = "timestamp",
    order: Sequence[str] = ("id",),
    size: str | int = "5 seconds",
    delay: str | int = "2 seconds",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Add ``is_late``: the row's window had closed before the row arrived.

    ``order`` is the order of arrival. The watermark before a row is the highest
    time of the earlier rows less ``delay``; a window closes when the watermark
    reaches its end.
    """
    seen = running_max_before(df, list(order), ts, "_seen", rows_per_chunk)
    window_end = tumbling_start(ts, size) + duration_ms(size)
    late = window_end <= F.col("_seen") - duration_ms(delay)
    return seen.withColumn("is_late", F.coalesce(late, F.lit(False))).drop("_seen")


def split_late(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """On-time rows and late rows; see :func:`mark_late`."""
    marked = mark_late(df, **options)
    return (
        marked.where("NOT is_late").drop("is_late"),
        marked.where("is_late").drop("is_late"),
    )


def late_row_shape(late: DataFrame, right: T.StructType) -> DataFrame:
    """Late rows with typed nulls in the columns of the side they never met."""
    missing = [f for f in right.fields if f.name not in late.columns]
    return late.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def with_late_rows(joined: DataFrame, late: DataFrame) -> DataFrame:
    """Joined rows and late rows together."""
    return joined.unionByName(late_row_shape(late, joined.schema))


def lookup_fill(
    df: DataFrame,
    table: DataFrame,
    key: str = "order_id",
    table_key: str = "oid",
    fill: Sequence[str] = ("total_money", "status", "uid", "province"),
    matched: str = "oid",
) -> DataFrame:
    """Fill the given columns of rows that found no order from the order table.

    ``main_source`` tells where they come from: ``joined``, ``lookup`` or
    ``none``. Only rows without a match can meet the table, which holds one row
    per key.
    """
    wanted = table.select(
        F.col(table_key).alias(key),
        F.lit(True).alias("_lone"),
        F.lit(True).alias("_found"),
        *[F.col(c).alias(f"_{c}") for c in fill],
    )
    rows = df.withColumn("_lone", F.col(matched).isNull())
    found = left_join(rows, wanted, [key, "_lone"])
    source = (
        F.when(~F.col("_lone"), "joined")
        .when(F.col("_found"), "lookup")
        .otherwise("none")
    )
    return found.select(
        *[
            F.coalesce(c, f"_{c}").alias(c) if c in fill else F.col(c)
            for c in df.columns
        ],
        source.alias("main_source"),
    )


def match_orders(
    details: DataFrame,
    orders: DataFrame,
    order_table: DataFrame,
    arrival: Sequence[str],
    size: str | int = "5 seconds",
    delay: str | int = "2 seconds",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Details with their order: joined in the window, else looked up by key.

    Late details skip the window and go straight to the lookup.
    """
    # A late row has no window, so it meets no order and needs no pass of its own.
    marked = mark_late(details, "update_ms", arrival, size, delay, rows_per_chunk)
    window = F.when(~F.col("is_late"), tumbling_start("update_ms", size))
    joined = left_join(
        marked.withColumn(WINDOW_START, window).drop("is_late"),
        _in_window(orders, "main_update_ms", size, delay).withColumn(
            "order_id", F.col("oid")
        ),
        ["order_id", WINDOW_START],
    )
    return lookup_fill(joined, order_table)


def group_buy(
    details: DataFrame,
    orders: DataFrame,
    groups: DataFrame,
    size: str | int = "5 seconds",
    delay: str | int = "0 seconds",
    along: Sequence[str] = (),
) -> DataFrame:
    """Group-purchase details with their order and then their group, window by window.

    Columns: details ``ts, user_id, group_id, order_id``; orders ``ts, order_id,
    status, amount``; groups ``ts, group_id, status, category``. A detail without
    an order or a group keeps nulls on that side. Further columns of orders and groups
    come along if named.
    """
    o = _in_window(
        orders.select(
            F.col("ts").alias("order_ts"),
            "order_id",
            F.col("status").alias("order_status"),
            F.col("amount").alias("order_amount"),
            *[c for c in along if c in orders.columns],
        ),
        "order_ts", size, delay,
    )
    g = _in_window(
        groups.select(
            F.col("ts").alias("group_ts"),
            "group_id",
            F.col("status").alias("group_status"),
            F.col("category").alias("group_category"),
            *[c for c in along if c in groups.columns],
        ),
        "group_ts", size, delay,
    )
    d = _in_window(details, "ts", size, delay)
    joined = left_join(d, o, ["order_id", WINDOW_START])
    return _start_ms(left_join(joined, g, ["group_id", WINDOW_START]))


def rescue_dropped(
    details: DataFrame,
    joined: DataFrame,
    order_table: DataFrame,
    ids: Sequence[str],
    closed_ms: int,
    size: str | int = "5 seconds",
) -> DataFrame:
    """Details a stream join dropped as late, filled from the order table.

    ``details`` are all details kept by the source, ``joined`` is what the stream
    has written, and ``closed_ms`` its watermark. A detail whose window has
    closed and that ``joined`` does not hold arrived too late.
    """
    window_end = tumbling_start("update_ms", size) + duration_ms(size)
    missing = details.where(window_end <= closed_ms).join(
        joined.select(*ids).distinct(), list(ids), "left_anti"
    )
    right = joined.select(*[c for c in joined.columns if c != WINDOW_START]).schema
    return lookup_fill(late_row_shape(missing, right), order_table)
