"""The order job as one stream: windows, late rows, and the order table for the rest.

Details and orders meet window by window in :mod:`.window_joins`, whose watermark follows
the slower side. Details that are late under it, and those that met no order until their
window closed, go to the order table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..operators.orders import lookup_fill, windowed_left_join
from ..sinks.tables import BatchWriter
from .window_joins import tagged, window_join_batches

TIMES = {"details": "update_ms", "mains": "main_update_ms"}


def order_stream(details: DataFrame, mains: DataFrame) -> DataFrame:
    """Details and orders as one stream, for :func:`order_filler`.

    Details have ``order_id`` and ``update_ms``, orders ``oid`` and ``main_update_ms``.
    """
    return tagged({"details": details, "mains": mains})


def order_filler(
    path: str,
    read_orders: Callable[[], DataFrame],
    write: BatchWriter,
    schemas: Mapping[str, T.StructType],
    ids: Sequence[str],
    size: str | int = "5 seconds",
    delay: str | int = "2 seconds",
) -> BatchWriter:
    """A ``foreachBatch`` function over :func:`order_stream`, with its state below ``path``.

    A detail that is on time comes out when it meets its order or its window closes, a late
    one at once. ``ids`` identify a detail; with a null in them, or if they came in an earlier
    batch, it comes out as late as well. The order table is read anew for every batch.
    """

    def join(details: DataFrame, mains: DataFrame) -> DataFrame:
        return windowed_left_join(
            details, mains, "order_id", "oid", size, delay, right_ts=TIMES["mains"]
        )

    def fill(rows: DataFrame, batch_id: int) -> None:
        write(lookup_fill(rows, read_orders()), batch_id)

    return window_join_batches(path, fill, schemas, TIMES, join, size, delay, late_ids=ids)
