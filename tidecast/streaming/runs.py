"""Running streams to completion and reading what they wrote."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..session import shared_folder
from ..settings import CHECKPOINT_INTERVAL_MS, insert_interval_ms


def finish(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything that is available now, then stop."""
    query = (
        writer.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def start(
    writer: DataStreamWriter, settings: Mapping[str, str], name: str
) -> StreamingQuery:
    """Start a standing job with the checkpoint folder and interval of the settings.

    Stopping the job keeps its checkpoint, and the next start goes on from there.
    """
    interval = int(settings.get("checkpoint.interval", CHECKPOINT_INTERVAL_MS))
    return (
        writer.queryName(name)
        .option("checkpointLocation", f"{settings['checkpoint.path'].rstrip('/')}/{name}")
        .trigger(processingTime=f"{interval} milliseconds")
        .start()
    )


def start_inserts(
    writer: DataStreamWriter, settings: Mapping[str, str], name: str
) -> StreamingQuery:
    """:func:`start` for a job that only inserts: a batch at each insert interval."""
    every = {**settings, "checkpoint.interval": str(insert_interval_ms(dict(settings)))}
    return start(writer, every, name)


def append_to_table(stream: DataFrame, purpose: str) -> DataFrame:
    """Run an append-mode stream into a parquet table and return the table."""
    spark = stream.sparkSession
    folder = shared_folder(spark, purpose)
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{folder}/rows")
    )
    finish(writer, f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def batches_to_table(
    stream: DataFrame,
    purpose: str,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    output_mode: str = "append",
) -> DataFrame:
    """Run a stream whose micro-batches are shaped and written one by one.

    A batch is computed once, however often the shape reads it.
    """
    from ..sinks.tables import held, read_table, table_writer

    spark = stream.sparkSession
    folder = shared_folder(spark, purpose)
    writer = stream.writeStream.outputMode(output_mode).foreachBatch(
        held(table_writer(f"{folder}/rows", shape))
    )
    finish(writer, f"{folder}/checkpoint")
    schema = shape(spark.createDataFrame([], stream.schema)).schema
    return read_table(spark, f"{folder}/rows", schema)


def run_batches(
    stream: DataFrame,
    purpose: str,
    make: Callable[[str, Callable], Callable],
    schema: str,
) -> DataFrame:
    """Run a stream through ``make(folder, write)``, a ``foreachBatch`` function with state.

    Returns the table of what it wrote, whose columns are those of ``schema``.
    """
    from ..sinks.tables import read_table, table_writer

    spark = stream.sparkSession
    folder = shared_folder(spark, purpose)
    each = make(f"{folder}/state", table_writer(f"{folder}/rows"))
    finish(stream.writeStream.foreachBatch(each), f"{folder}/checkpoint")
    like = spark.createDataFrame([], schema)
    return read_table(spark, f"{folder}/rows", like.schema).drop("batch")


def stream_files(
    spark: SparkSession, like: DataFrame, folder: str, name: str, max_files: int = 100
) -> DataFrame:
    """A stream over the parquet files of a folder with the columns of ``like``."""
    return (
        spark.readStream.schema(like.schema)
        .option("pathGlobFilter", name)
        .option("maxFilesPerTrigger", max_files)
        .parquet(folder)
    )
