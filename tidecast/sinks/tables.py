"""Detail tables and keyed snapshots written batch by batch.

Each micro-batch owns the folder ``batch=<id>`` and replaces it as a whole, so a
batch that runs again after a failure leaves the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import event_time, join_text
from ..schemas import ANCHOR_DETAIL_COLUMNS, USER_EVENT_COLUMNS
from ..settings import INSERT_ROWS, insert_rows

BatchWriter = Callable[[DataFrame, int], None]


def table_writer(
    path: str,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    partition_by: Sequence[str] = (),
) -> BatchWriter:
    """A ``foreachBatch`` function that writes shaped rows to a parquet table.

    A stream that starts at batch 0 on a table of earlier batches has lost its
    checkpoint, or the table is another stream's: that is an error, as the new batches
    would replace the old ones.
    """
    started = False

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal started
        if not started and batch_id == 0 and _last_batch(batch.sparkSession, path) > 0:
            raise ValueError(f"{path} holds later batches; start it with their checkpoint")
        started = True
        rows = shape(batch)
        if partition_by:
            # Few files per partition, while a large partition still gets several.
            rows = rows.hint("rebalance", *partition_by)
        writer = rows.write.mode("overwrite").partitionBy(*partition_by)
        writer.parquet(f"{path}/batch={batch_id}")

    return write


def _last_batch(spark: SparkSession, path: str) -> int:
    """Number of the table's last batch, -1 without any."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return -1
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return max((int(n[6:]) for n in names if n.startswith("batch=")), default=-1)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a batch table, with the number of the batch that wrote them."""
    return (
        spark.read.schema(
            T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        )
        .option("basePath", path)
        .parquet(path)
    )


def jdbc_writer(
    options: Mapping[str, str],
    table: str,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    rows_per_insert: int = INSERT_ROWS,
) -> BatchWriter:
    """A ``foreachBatch`` function that appends shaped rows to a database table.

    Rows may appear twice after a failure; the target keeps the latest per id.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            shape(batch)
            .write.format("jdbc")
            .options(**options)
            .option("dbtable", table)
            .option("batchsize", rows_per_insert)
            .mode("append")
            .save()
        )

    return write


def insert_writer(
    settings: Mapping[str, str],
    options: Mapping[str, str],
    table: str,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> BatchWriter:
    """:func:`jdbc_writer` with the rows per insert of the settings file."""
    return jdbc_writer(options, table, shape, insert_rows(settings))


def user_event_rows(events: DataFrame, process_time=None) -> DataFrame:
    """The 12 columns of the user-event table; ``processTime`` is in seconds."""
    now = F.unix_timestamp() if process_time is None else process_time
    return events.withColumn("processTime", now.cast("long")).select(
        *USER_EVENT_COLUMNS
    )


def anchor_detail_rows(visits: DataFrame, process_time=None) -> DataFrame:
    """The columns of the room-detail table, stamped with the time of writing."""
    now = F.current_timestamp() if process_time is None else process_time
    return visits.select(
        "id",
        "anchor_id",
        "deviceId",
        "eventId",
        F.col("osName").alias("os"),
        "province",
        F.col("releaseChannel").alias("channel"),
        "deviceType",
        event_time("timestamp").alias("eventTime"),
        "date",
        "hour",
        now.alias("processTime"),
    ).select(*ANCHOR_DETAIL_COLUMNS)


def latest_by(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]
) -> DataFrame:
    """The newest row per key. Older copies are dropped before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in newest_first])
    return (
        df.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_details(table: DataFrame) -> DataFrame:
    """Room-detail table as its readers see it: one row per id, the newest."""
    order = ["processTime", *[c for c in ("batch",) if c in table.columns]]
    return latest_by(table, ["date", "hour", "id"], order)


def snapshot_pairs(snapshots: DataFrame) -> DataFrame:
    """Key and value of each snapshot row: ``anchor_date`` and ``uv,pv,online``."""
    return snapshots.select(
        F.col("anchor_date").alias("key"),
        join_text(",", "uv", "pv", "online").alias("value"),
        F.col("bucket_start").alias("seq"),
    )


def latest_snapshot(pairs: DataFrame) -> DataFrame:
    """The value written last for each key."""
    order = [*[c for c in ("batch",) if c in pairs.columns], "seq"]
    return latest_by(pairs, ["key"], order).select("key", "value")


def multi_writer(*writers: tuple[Callable[[DataFrame], DataFrame], BatchWriter]):
    """One ``foreachBatch`` function for several outputs of the same rows.

    Each pair is the view of the batch and the function that writes it. The
    batch is computed once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for view, writer in writers:
                writer(view(batch), batch_id)
        finally:
            batch.unpersist()

    return write


def held(write: BatchWriter) -> BatchWriter:
    """``write`` for batches that it reads more than once: each is computed once.

    Otherwise every read runs the stream's operators anew, state included.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write(batch, batch_id)
        finally:
            batch.unpersist()

    return each


def console(stream: DataFrame, rows: int | None = None):
    """A writer that prints each micro-batch, all of it unless ``rows`` is given."""
    most = 2**31 - 1 if rows is None else rows
    return stream.writeStream.format("console").option("numRows", most).option(
        "truncate", "false"
    )
