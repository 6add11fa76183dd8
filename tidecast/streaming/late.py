"""Late rows of a stream, told apart by the engine's own watermark.

Spark drops rows whose window the watermark has closed, silently. Here each row goes
two ways in one query: as it is, and as a key through a deduplication on the window,
which drops late ones. Rows of a micro-batch whose key did not come through are late.
Their number depends on the batch alone, and the keys leave the state with their window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import duration_ms, event_time
from ..operators.orders import tumbling_start

_MARK, _WINDOW = "_on_time_key", "_window"


def with_on_time_keys(
    rows: DataFrame,
    ids: Sequence[str] = ("id",),
    ts: str = "timestamp",
    size: str | int = "5 seconds",
    delay: str | int = "2 seconds",
) -> DataFrame:
    """The rows of a stream and, as rows of their own, the keys of those on time.

    ``ids`` identify a row. A row without a time is on time.
    """
    timed = rows.withColumn("_ts", event_time(ts)).withWatermark("_ts", f"{duration_ms(delay)} milliseconds")
    window = F.window("_ts", f"{duration_ms(size)} milliseconds").alias(_WINDOW)
    keys = timed.where(F.col("_ts").isNotNull()).select(*ids, window)
    keys = keys.dropDuplicates([*ids, _WINDOW]).select(*ids, F.lit(True).alias(_MARK))
    return rows.withColumn(_MARK, F.lit(False)).unionByName(keys, allowMissingColumns=True)


def mark_late_batch(batch: DataFrame, ids: Sequence[str] = ("id",), ts: str = "timestamp") -> DataFrame:
    """Rows of a :func:`with_on_time_keys` batch with ``is_late``."""
    rows = batch.where(~F.col(_MARK)).drop(_MARK)
    on_time = batch.where(_MARK).select(*ids).distinct().withColumn("_on_time", F.lit(True))
    met = rows.join(on_time, list(ids), "left")
    late = F.col("_on_time").isNull() & F.col(ts).isNotNull()
    return met.withColumn("is_late", late).drop("_on_time")


def late_by_open_windows(
    rows: DataFrame, earlier: DataFrame, ids: Sequence[str], ts: str, size: str | int, closed: int
) -> DataFrame:
    """The late rows of a batch as :func:`mark_late_batch` tells them, without a state store.

    Windows that end by ``closed`` have closed before the batch; ``earlier`` are the rows of
    earlier batches in windows still open. A key that came before, or that has a null, does
    not come through a deduplication, so rows with such keys are late as well.
    """
    start = tumbling_start(ts, size)
    timed = rows.where(F.col(ts).isNotNull())
    closed_or_null = reduce(
        lambda x, y: x | y, [F.col(i).isNull() for i in ids], start + duration_ms(size) <= closed
    )
    late, others = timed.where(closed_or_null), timed.where(~closed_or_null)
    high = earlier.agg(F.max(start)).first()[0]
    low = others.agg(F.min(start)).first()[0]
    if high is None or low is None:
        return late
    # Only windows that have rows on both sides can hold a key twice.
    known = earlier.where(start >= low).select(*ids, start.alias(_WINDOW))
    again = others.where(start <= high).withColumn(_WINDOW, start)
    return late.unionByName(again.join(known, [*ids, _WINDOW], "left_semi").drop(_WINDOW))


def late_splitter(
    on_time: Callable[[DataFrame, int], None],
    late: Callable[[DataFrame, int], None],
    ids: Sequence[str] = ("id",),
    ts: str = "timestamp",
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that hands on-time and late rows to two writers."""

    def each(batch: DataFrame, batch_id: int) -> None:
        marked = mark_late_batch(batch, ids, ts).persist()
        try:
            on_time(marked.where("NOT is_late").drop("is_late"), batch_id)
            late(marked.where("is_late").drop("is_late"), batch_id)
        finally:
            marked.unpersist()

    return each
