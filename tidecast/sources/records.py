"""Raw records: Kafka or files in, ids and text out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import join_text, utf8

# Layout of a Kafka source row; a file of the same layout can stand in for it.
RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.BinaryType()),
    ]
)


def kafka_options(conf: Mapping[str, str], topics: str | None = None) -> dict[str, str]:
    """Spark's Kafka options from the platform's settings.

    ``topics`` is a comma list and defaults to ``kafka.input.topics``. Offsets
    are kept in the query's checkpoint, so the group is only a name prefix.
    """
    options = {
        "kafka.bootstrap.servers": conf["bootstrap.servers"],
        "subscribe": ",".join(
            t.strip() for t in (topics or conf["kafka.input.topics"]).split(",")
        ),
        "startingOffsets": conf.get("auto.offset.reset", "earliest"),
        "kafka.isolation.level": conf.get("isolation.level", "read_committed"),
        "failOnDataLoss": "true",
    }
    if "group.id" in conf:
        options["groupIdPrefix"] = conf["group.id"]
    if "max.offsets.per.trigger" in conf:
        options["maxOffsetsPerTrigger"] = conf["max.offsets.per.trigger"]
    return options


def read_kafka(
    spark: SparkSession, conf: Mapping[str, str], topics: str | None = None
) -> DataFrame:
    """A stream of Kafka records. Needs Spark's Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(conf, topics)).load()


def read_record_files(
    spark: SparkSession, path: str, max_files: int = 100
) -> DataFrame:
    """A stream of parquet files that hold Kafka-shaped records."""
    return (
        spark.readStream.schema(RECORD)
        .option("maxFilesPerTrigger", max_files)
        .parquet(path)
    )


def record_values(records: DataFrame) -> DataFrame:
    """The records' text."""
    return records.select(utf8("value").alias("value"))


def with_record_id(records: DataFrame) -> DataFrame:
    """``(id, value)`` with ``id`` = topic-partition-offset."""
    return records.select(
        join_text("-", "topic", "partition", "offset").alias("id"),
        utf8("value").alias("value"),
    )


def parse_delimited(
    lines: DataFrame,
    schema: T.StructType,
    sep: str = ",",
    column: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Lines split at ``sep`` and typed by position.

    A line with too few parts or a part of the wrong type is dropped; further
    parts are ignored. ``keep`` names other columns to carry along.
    """
    parts = F.split(F.col(column), f"\\Q{sep}\\E")
    typed = lines.select(
        *keep,
        F.size(parts).alias("_size"),
        *[
            F.get(parts, F.lit(i)).try_cast(field.dataType).alias(field.name)
            for i, field in enumerate(schema.fields)
        ],
    )
    whole = F.col("_size") >= len(schema.fields)
    for field in schema.fields:
        whole = whole & F.col(field.name).isNotNull()
    return typed.where(whole).drop("_size")
