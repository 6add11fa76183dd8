"""Joins of streams in event-time windows, with open windows carried as tables.

Spark's stream-stream join writes, reads and deletes every row in a state store by itself,
some 60 microseconds a row. Here the rows of windows still open are tables that a
micro-batch leaves for the next one, and a batch meets them in a join of tables. What
comes out, and in which batch, is as in the stream-stream join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import duration_ms
from ..operators.orders import WINDOW_START, late_row_shape, tumbling_start
from ..session import shared_folder
from ..sinks.tables import BatchWriter, read_table, table_writer
from .carried import Carried
from .late import late_by_open_windows
from .runs import finish

Join = Callable[..., DataFrame]


def arrived(side: str) -> str:
    """Column with the number of the batch in which a side's row arrived."""
    return f"_arrived_{side}"


def _marked(schema: T.StructType, side: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(arrived(side), T.LongType())])


def tagged(sides: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of several streams as one, each in a struct named like its side."""
    structs = [rows.select(F.struct("*").alias(side)) for side, rows in sides.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), structs)


def window_join_batches(
    path: str,
    write: BatchWriter,
    schemas: Mapping[str, T.StructType],
    times: Mapping[str, str],
    join: Join,
    size: str | int = "5 seconds",
    delay: str | int = "2 seconds",
    late_ids: Sequence[str] | None = None,
) -> BatchWriter:
    """A ``foreachBatch`` function over :func:`tagged` rows that joins them window by window.

    ``join`` gets the sides' rows in the order of ``times``, the names of their time
    columns, and left joins the first side with the others in its window; it keeps the
    columns :func:`arrived`. Rows that met all sides come out in the batch of the last one
    of them, others once the watermark has passed their window. The watermark is the least
    of the sides' highest times in earlier batches, less ``delay``; rows whose window the
    previous batch's watermark had passed are late and dropped, as are those without a time.

    With ``late_ids``, the columns that identify a row of the first side, its late rows come
    out in their own batch, without a window, as :func:`.late.late_by_open_windows` tells them.
    """
    width, wait, names = duration_ms(size), duration_ms(delay), list(times)
    tops = [f"top_{side}" for side in names]
    marks = Carried(f"{path}/marks", ", ".join(f"{c} bigint" for c in [*tops, "closed"]))
    opened = {side: Carried(f"{path}/{side}", _marked(schemas[side], side)) for side in names}

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            step(batch, batch_id)
        finally:
            batch.unpersist()

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = marks.before(spark, batch_id).first()
        closed_before = before["closed"] if before else 0
        known = [before[top] if before else None for top in tops]
        # A side without any time holds the watermark back.
        closed = max(closed_before, min(top - wait for top in known)) if None not in known else closed_before
        arrivals, rows = {}, {}
        for side, ts in times.items():
            arrivals[side] = batch.where(F.col(side).isNotNull()).select(f"{side}.*")
            new = arrivals[side].where(tumbling_start(ts, size) + width > closed_before)
            rows[side] = new.withColumn(arrived(side), F.lit(batch_id).cast("long")).unionByName(
                opened[side].before(spark, batch_id)
            )
        came = [F.col(arrived(side)) for side in names]
        met = reduce(lambda x, y: x & y, [c.isNotNull() for c in came])
        past = F.col(WINDOW_START) + width <= closed
        joined = join(*rows.values()).where(
            F.when(met, F.greatest(*came) == batch_id).otherwise(past)
        )
        joined = joined.drop(*map(arrived, names))
        if late_ids is not None:
            side, ts = names[0], times[names[0]]
            still_open = opened[side].before(spark, batch_id)
            late = late_by_open_windows(arrivals[side], still_open, late_ids, ts, size, closed_before)
            joined = joined.unionByName(late_row_shape(late, joined.schema))
        write(joined, batch_id)
        for side, ts in times.items():
            opened[side].leave(rows[side].where(tumbling_start(ts, size) + width > closed), batch_id)
        found = batch.agg(*[F.max(f"{side}.{ts}").alias(top) for top, (side, ts) in zip(tops, times.items())])
        earlier = [F.greatest(top, F.lit(k).cast("long")).alias(top) for top, k in zip(tops, known)]
        marks.leave(found.select(*earlier, F.lit(closed).cast("long").alias("closed")), batch_id)

    return each


def finish_windows(stream: DataFrame, each: BatchWriter, checkpoint: str) -> None:
    """Run :func:`tagged` rows through :func:`window_join_batches` to the streams' end.

    A last call without rows closes what the last batch's times have closed. A batch that
    comes later has its number, and replaces its rows.
    """
    done = []

    def batch_done(batch: DataFrame, batch_id: int) -> None:
        each(batch, batch_id)
        done.append(batch_id)

    finish(stream.writeStream.foreachBatch(batch_done), checkpoint)
    each(stream.sparkSession.createDataFrame([], stream.schema), max(done, default=-1) + 1)


def window_joined(
    sides: Mapping[str, DataFrame],
    times: Mapping[str, str],
    purpose: str,
    join: Join,
    size: str | int = "5 seconds",
    delay: str | int = "2 seconds",
) -> DataFrame:
    """Run :func:`window_join_batches` over streams to their end; the table of its rows."""
    stream = tagged(sides)
    spark = stream.sparkSession
    folder = shared_folder(spark, purpose)
    schemas = {side: rows.schema for side, rows in sides.items()}
    each = window_join_batches(
        f"{folder}/state", table_writer(f"{folder}/rows"), schemas, times, join, size, delay
    )
    finish_windows(stream, each, f"{folder}/checkpoint")
    none = [spark.createDataFrame([], _marked(schemas[side], side)) for side in times]
    schema = join(*none).drop(*map(arrived, times)).schema
    return read_table(spark, f"{folder}/rows", schema).drop("batch")
