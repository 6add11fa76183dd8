"""JSON events and change-capture envelopes to typed rows.

Values are read as text and then cast, because producers write numbers both
bare and quoted. A record that is not the expected JSON, or holds a value its
field cannot take, is dropped; :func:`checked_events` and :func:`checked_cdc` keep it
with the reason.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EVENT, EVENT_ZERO_DEFAULTS

OPTIONS = {"mode": "PERMISSIVE", "allowUnquotedFieldNames": "true"}
CHANGE_TYPES = ("INSERT", "UPDATE", "DELETE")


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def _sole_object(raw: DataFrame, value: str, schema: T.StructType, out: str) -> DataFrame:
    """Add the record's one JSON object as ``out``; drop records that are anything else.

    White space around the object does not matter. The reader would stop at the
    object's end, so the text is read as an array's inside, where only one object and
    nothing behind it is allowed.
    """
    inside = F.from_json(
        F.concat(F.lit("["), value, F.lit("]")), T.ArrayType(schema), OPTIONS
    )
    found = raw.withColumn(out, _once(inside)).where(F.size(out) == 1)
    return found.withColumn(out, F.get(out, F.lit(0))).where(F.col(out).isNotNull())


def _once(struct: Column) -> Column:
    # As a generator's output the struct stays one expression. A plain column
    # would be computed again in every filter pushed below it.
    return F.explode(F.array(struct))


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType)


def _typed(raw: Column, kind: T.DataType) -> Column:
    if _is_text(kind):
        return raw
    if isinstance(kind, T.MapType):
        return F.from_json(raw, kind, OPTIONS)
    if isinstance(kind, T.TimestampType):
        millis = F.timestamp_millis(raw.try_cast("bigint"))
        return F.coalesce(millis, raw.try_cast("timestamp"))
    return raw.try_cast(kind)


def _typed_rows(df: DataFrame, text_row: str, schema: T.StructType) -> DataFrame:
    """Add ``_row``, the typed form of a struct of texts; drop what does not convert.

    Empty text and ``null`` are no value, any other unusable text is a failure.
    """
    typed = df.withColumn(
        "_row",
        _once(
            F.struct(
                *[
                    _typed(F.col(f"{text_row}.{f.name}"), f.dataType).alias(f.name)
                    for f in schema.fields
                ]
            )
        ),
    )
    whole = F.lit(True)
    for f in schema.fields:
        if not _is_text(f.dataType):
            raw = F.col(f"{text_row}.{f.name}")
            no_value = F.coalesce(raw, F.lit("")).isin("", "null")
            whole = whole & (F.col(f"_row.{f.name}").isNotNull() | no_value)
    return typed.where(whole)


def parse_events(
    raw: DataFrame, value: str = "value", id_column: str | None = None
) -> DataFrame:
    """JSON text to event rows; ``id_column`` names the record's id, if it has one."""
    whole = _sole_object(raw, value, _as_text(EVENT), "_event")
    kept = [id_column] if id_column else []
    names = [n for n in EVENT.names if n != "id" or not id_column]
    events = _typed_rows(whole.select(*kept, "_event"), "_event", EVENT).select(
        *[F.col(c).alias("id") for c in kept], *[f"_row.{n}" for n in names]
    )
    return events.withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in EVENT_ZERO_DEFAULTS}
    )


def parse_cdc(
    raw: DataFrame,
    item_schema: T.StructType,
    ops: Sequence[str] = CHANGE_TYPES,
    value: str = "value",
) -> DataFrame:
    """Change envelopes ``{type, data: [...]}`` to one row per item plus ``type``."""
    envelope = T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("data", T.ArrayType(_as_text(item_schema))),
        ]
    )
    items = (
        _sole_object(raw.select(value), value, envelope, "_message")
        .where(F.col("_message.type").isin(*ops))
        .select(
            F.explode("_message.data").alias("_item"),
            F.col("_message.type").alias("type"),
        )
        .where("_item IS NOT NULL")
    )
    return _typed_rows(items, "_item", item_schema).select(
        *[f"_row.{n}" for n in item_schema.names], "type"
    )


#: Why a record or an item is rejected; a field that fails is named behind the last.
NO_OBJECT, NO_ITEMS, NO_ITEM, BAD_VALUE = "no single object", "no items", "no item", "bad value: "


def _parsed_object(value: str, schema: T.StructType) -> Column:
    """The record's one JSON object; null for anything else."""
    inside = F.from_json(F.concat(F.lit("["), value, F.lit("]")), T.ArrayType(schema), OPTIONS)
    return F.transform(F.array(inside), lambda a: F.when(F.size(a) == 1, F.get(a, F.lit(0))))[0]


def _first_failure(text_row: str, schema: T.StructType, typed: str) -> Column:
    """Name of the first field whose text does not convert; null if all do."""
    failure = F.lit(None).cast("string")
    for f in reversed(schema.fields):
        if not _is_text(f.dataType):
            raw = F.col(f"{text_row}.{f.name}")
            no_value = F.coalesce(raw, F.lit("")).isin("", "null")
            failed = F.col(f"{typed}.{f.name}").isNull() & ~no_value
            failure = F.when(failed, F.lit(f.name)).otherwise(failure)
    return failure


def _typed_struct(text_row: str, schema: T.StructType) -> Column:
    return F.struct(
        *[_typed(F.col(f"{text_row}.{f.name}"), f.dataType).alias(f.name) for f in schema.fields]
    )


def checked_events(raw: DataFrame, value: str = "value", id_column: str | None = None) -> DataFrame:
    """Every raw record with ``event`` and ``reason``, of which one is null.

    Records without a reason are those of :func:`parse_events`, and ``event`` is their
    row. The raw columns stay, so a rejected record can be stored as it came.
    """
    texts = raw.withColumn("_text", _once(_parsed_object(value, _as_text(EVENT))))
    typed = texts.withColumn("_row", _once(_typed_struct("_text", EVENT)))
    failure = _first_failure("_text", EVENT, "_row")
    reason = F.when(F.col("_text").isNull(), NO_OBJECT).when(
        failure.isNotNull(), F.concat(F.lit(BAD_VALUE), failure)
    )
    own_id = [F.col(id_column).alias("id")] if id_column else []
    row = F.struct(
        *own_id,
        *[
            (F.coalesce(F.col(f"_row.{n}"), F.lit(0)) if n in EVENT_ZERO_DEFAULTS else F.col(f"_row.{n}")).alias(n)
            for n in EVENT.names
            if n != "id" or not id_column
        ],
    )
    return typed.withColumn("reason", reason).select(
        *raw.columns, F.when(F.col("reason").isNull(), row).alias("event"), "reason"
    )


def checked_cdc(
    raw: DataFrame, item_schema: T.StructType, ops: Sequence[str] = CHANGE_TYPES, value: str = "value"
) -> DataFrame:
    """Every item of every envelope, and every record without one, with its ``reason``.

    ``item`` is the typed row, null where there is a reason. ``place`` counts a record's
    items from 0 and is null where the record itself is rejected. Items without a reason
    are those of :func:`parse_cdc`. Envelopes of other types are left out, as there.
    """
    envelope = T.StructType(
        [T.StructField("type", T.StringType()), T.StructField("data", T.ArrayType(_as_text(item_schema)))]
    )
    found = raw.withColumn("_message", _once(_parsed_object(value, envelope)))
    wanted = F.col("_message").isNull() | F.coalesce(F.col("_message.type"), F.lit("")).isin(*ops)
    items = found.where(wanted).select(
        *raw.columns, "_message", F.posexplode_outer("_message.data").alias("place", "_item")
    )
    typed = items.withColumn("_row", _once(_typed_struct("_item", item_schema)))
    failure = _first_failure("_item", item_schema, "_row")
    reason = (
        F.when(F.col("_message").isNull(), NO_OBJECT)
        .when(F.col("place").isNull(), NO_ITEMS)
        .when(F.col("_item").isNull(), NO_ITEM)
        .when(failure.isNotNull(), F.concat(F.lit(BAD_VALUE), failure))
    )
    return typed.withColumn("reason", reason).select(
        *raw.columns, F.col("_message.type").alias("type"), "place",
        F.when(F.col("reason").isNull(), F.col("_row")).alias("item"), "reason",
    )


def counted(checked: DataFrame, name: str) -> DataFrame:
    """``checked`` rows with an observation ``name`` of how many were kept and rejected.

    The counts come with the batch that Spark runs anyway: from an ``Observation`` of
    that name, or from a stream's progress.
    """
    return checked.observe(
        name,
        F.count_if(F.col("reason").isNull()).alias("kept"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
    )


def rejecting_writer(write: Callable, write_rejected: Callable, row: str = "event") -> Callable:
    """A ``foreachBatch`` function over checked rows: kept rows to one writer, others beside."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write(batch.where(F.col("reason").isNull()).select(f"{row}.*"), batch_id)
            write_rejected(batch.where(F.col("reason").isNotNull()).drop(row), batch_id)
        finally:
            batch.unpersist()

    return each
