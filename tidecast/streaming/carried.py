"""What a micro-batch leaves for the next one, as a table, and running totals upon it.

The rows of a batch are summed like those of a table: keys with many rows are cut into
chunks, so a crowded room is spread over tasks. Only totals, one row per key, are carried.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import audience, users
from ..plans.chunks import running_floored_sums, running_sums
from ..sinks.tables import BatchWriter
from .first_seen import flagged_batch

_START = "_start"


class Carried:
    """A table below ``path`` that each micro-batch replaces for the next one.

    Batch n reads what batch n - 1 left and leaves its own, so one that runs again
    starts from the same rows. What no batch can read again is deleted.
    """

    def __init__(self, path: str, schema: T.StructType | str) -> None:
        self.path = path
        self.schema = schema

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What the previous batch left; no rows for the first one."""
        if batch_id == 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/batch={batch_id - 1}")

    def leave(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={batch_id - 2}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def carried_sums(
    path: str,
    schema: T.StructType | str,
    steps: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str],
    write: BatchWriter,
    floored: str | None = None,
    rows_per_chunk: int | None = None,
) -> BatchWriter:
    """A ``foreachBatch`` function that writes running sums over all batches so far.

    ``steps`` makes of a batch the rows whose columns ``sums`` add up along ``order``;
    ``schema`` is that of ``keys`` and ``sums``. The totals of earlier batches stand as a
    row before the first of each key. ``floored`` is held at zero or above; its keys must
    not be null.
    """
    totals = Carried(f"{path}/totals", schema)
    adds: Mapping[str, Column] = {name: F.col(name) for name in sums}

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        rows = steps(batch)
        # Without a place in the order a row comes first.
        start = totals.before(batch.sparkSession, batch_id).withColumn(_START, F.lit(True))
        both = rows.withColumn(_START, F.lit(False)).unionByName(start, allowMissingColumns=True)
        if floored is None:
            counted = running_sums(both, keys, order, adds, rows_per_chunk, rows)
        else:
            counted = running_floored_sums(both, keys, order, adds, floored, rows_per_chunk, rows)
        counted.persist()
        try:
            write(counted.where(~F.col(_START)).drop(_START), batch_id)
            last = F.max_by(F.struct(*sums), F.struct(~F.col(_START), *order))
            ends = counted.groupBy(*keys).agg(last.alias("_last"))
            totals.leave(ends.select(*keys, "_last.*").to(_as_struct(batch, schema)), batch_id)
        finally:
            counted.unpersist()
            batch.unpersist()

    return each


def _as_struct(batch: DataFrame, schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return batch.sparkSession.createDataFrame([], schema).schema


AUDIENCE_SUMS = ("uv", "pv", "online")


def audience_batches(
    path: str, write: BatchWriter, floor_at_zero: bool = True, rows_per_chunk: int | None = None
) -> BatchWriter:
    """Running uv, pv and people online of rooms, over :func:`first_seen.marked` visits.

    Gives the rows of :func:`audience.audience`.
    """

    def steps(batch: DataFrame) -> DataFrame:
        visits = flagged_batch(batch, "deviceId", ("anchor_id", "entered"))
        return audience.flagged_increments(visits)

    return carried_sums(
        path, "anchor_id string, uv bigint, pv bigint, online bigint", steps, ["anchor_id"],
        ["timestamp", "id"], AUDIENCE_SUMS, write, "online" if floor_at_zero else None, rows_per_chunk,
    )


def first_seen_count_batches(
    path: str,
    write: BatchWriter,
    user: str = "deviceId",
    key: str = "releaseChannel",
    order: Sequence[str] = users.ORDER,
    rows_per_chunk: int | None = None,
) -> BatchWriter:
    """Rows with ``isN`` and ``perCnt`` of :func:`users.count_first_seen`, over marked rows."""

    def steps(batch: DataFrame) -> DataFrame:
        rows = flagged_batch(batch, user, (), order)
        return rows.withColumn("perCnt", F.col("isN").cast("bigint"))

    def shaped(counted: DataFrame, batch_id: int) -> None:
        count = F.when(F.col("isN") == 1, F.col("perCnt")).otherwise(0)
        write(counted.withColumn("perCnt", count.cast("int")), batch_id)

    return carried_sums(
        path, f"{key} string, perCnt bigint", steps, [key], list(order), ["perCnt"], shaped,
        rows_per_chunk=rows_per_chunk,
    )


def running_sum_batches(
    path: str,
    write: BatchWriter,
    key: str = "category",
    value: str = "quantity",
    order: Sequence[str] = users.ORDER,
    rows_per_chunk: int | None = None,
) -> BatchWriter:
    """Rows with ``total``, the sum of ``value`` per key over all batches so far."""

    def steps(batch: DataFrame) -> DataFrame:
        return batch.select(key, *order, F.col(value).cast("bigint").alias("total"))

    return carried_sums(
        path, f"{key} string, total bigint", steps, [key], list(order), ["total"], write,
        rows_per_chunk=rows_per_chunk,
    )
