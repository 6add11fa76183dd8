"""Sliding product counts and the top products of each category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import duration_ms, event_time, floor_ms

PRODUCT_KEYS = ("eventId", "categoryId", "productId")
GROUP_KEYS = ("categoryId", "eventId", "windowStart", "windowEnd")


def sliding_count(
    df: DataFrame,
    keys: Sequence[str] = PRODUCT_KEYS,
    size: str | int = "10 minutes",
    slide: str | int = "1 minute",
    delay: str | int = "5 seconds",
) -> DataFrame:
    """Rows per key and sliding event-time window, with the window's bounds in ms.

    A batch is counted per slide first and only those counts are copied into the
    windows they belong to. A stream uses the watermark ``delay`` and emits
    windows as they close.
    """
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    if df.isStreaming:
        counted = (
            df.withColumn("_ts", event_time("timestamp"))
            .withWatermark("_ts", f"{duration_ms(delay)} milliseconds")
            .groupBy(
                F.window(
                    "_ts", f"{size_ms} milliseconds", f"{slide_ms} milliseconds"
                ).alias("_window"),
                *keys,
            )
            .agg(F.count("*").alias("count"))
        )
        return counted.select(
            *keys,
            "count",
            F.unix_millis("_window.start").alias("windowStart"),
            F.unix_millis("_window.end").alias("windowEnd"),
        )
    if size_ms % slide_ms:
        return (
            df.select(*keys, _window_starts("timestamp", size_ms, slide_ms))
            .groupBy(*keys, "windowStart")
            .agg(F.count("*").alias("count"))
            .withColumn("windowEnd", F.col("windowStart") + size_ms)
        )
    panes = df.groupBy(*keys, floor_ms("timestamp", slide_ms).alias("_pane")).agg(
        F.count("*").alias("_n")
    )
    return (
        panes.select(*keys, "_n", _window_starts("_pane", size_ms, slide_ms))
        .groupBy(*keys, "windowStart")
        .agg(F.sum("_n").alias("count"))
        .withColumn("windowEnd", F.col("windowStart") + size_ms)
    )


def _window_starts(ms: str, size_ms: int, slide_ms: int) -> Column:
    """One row per window that holds the instant."""
    last = floor_ms(ms, slide_ms)
    newest_closed = F.col(ms) - size_ms
    first = floor_ms(newest_closed, slide_ms) + slide_ms
    return F.explode(F.sequence(first, last, F.lit(slide_ms).cast("long"))).alias(
        "windowStart"
    )


def top_n(
    df: DataFrame,
    keys: Sequence[str] = GROUP_KEYS,
    order: Sequence[Column | str] | None = None,
    n: int = 3,
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1 in ``rank``.

    Spark trims every task's rows to n per group before the shuffle.
    """
    ranking = order or (F.desc("count"), F.asc("productId"))
    numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking))
    return df.withColumn("rank", numbered).where(F.col("rank") <= n)


def top_products(
    df: DataFrame,
    size: str | int = "10 minutes",
    slide: str | int = "1 minute",
    n: int = 3,
) -> DataFrame:
    """Top products per category, event and sliding window (batch)."""
    return top_n(sliding_count(df, PRODUCT_KEYS, size, slide), n=n)


def top_lists(ranked: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """The ranked rows of a group as one list, in rank order (at most n items)."""
    item = F.struct("rank", "productId", "count")
    return ranked.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(item)),
            lambda x: F.struct(x["productId"].alias("productId"), x["count"].alias("count")),
        ).alias("items")
    )
