"""Sinks: rows written by micro-batches and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import date_text, hour_text
from ..operators import filters
from ..operators.audience import (
    audience_snapshot,
    snapshot_from_increments,
    snapshot_increments,
    visit_detail,
)
from ..operators.location import enrich_location
from ..session import shared_folder
from ..schemas import TEST_LINE
from ..sinks import tables
from ..sinks.committed import CommittedFiles, read_published
from ..sinks.manifest import ManifestTable
from ..sources.records import parse_delimited
from ..streaming.first_seen import flagged_batch, marked
from ..streaming.runs import finish
from . import inputs
from .audience import _snapshot_sql
from .registry import query


def _event_stream(spark, folder):
    return inputs.live_events(inputs.table_stream(spark, folder, "events"))


def _run(stream, writer, folder):
    finish(stream.writeStream.foreachBatch(writer), f"{folder}/checkpoint")


def _twice(writer):
    """Write every batch two times, as after a failure between write and commit."""

    def write(batch, batch_id):
        writer(batch, batch_id)
        writer(batch, batch_id)

    return write


PLACED_SQL = f"""WITH {inputs.VISITS_SQL}, {inputs.REGIONS_SQL}
    SELECT CAST(id AS VARCHAR) AS id, {{columns}}
    FROM {{rows}} LEFT JOIN regions
      ON longitude >= lon_min AND longitude < lon_max
     AND latitude >= lat_min AND latitude < lat_max"""
DATE_HOUR = (
    "strftime(make_timestamp(\"timestamp\" * 1000), '%Y%m%d') AS date, "
    "strftime(make_timestamp(\"timestamp\" * 1000), '%H') AS hour"
)


def _placed(spark, folder, events):
    placed = enrich_location(events, inputs.regions(spark, folder))
    return placed.withColumns(
        {
            "id": F.col("id").cast("string"),
            "date": date_text("timestamp"),
            "hour": hour_text("timestamp"),
        }
    )


@query(
    "sink_user_event",
    PLACED_SQL.format(
        rows="live",
        columns=f'"deviceId", "eventId", "isNew", "osName", province, "releaseChannel",'
        f' "deviceType", "timestamp", {DATE_HOUR}',
    ),
)
def _user_event(spark, folder):
    path = shared_folder(spark, "user-event")
    rows = _placed(spark, folder, _event_stream(spark, folder))
    writer = tables.table_writer(
        f"{path}/rows", tables.user_event_rows, partition_by=("date", "hour")
    )
    _run(rows, _twice(writer), path)
    schema = tables.user_event_rows(rows).schema
    return tables.read_table(spark, f"{path}/rows", schema).drop("processTime", "batch")


@query(
    "sink_small_batch",
    f"""WITH {inputs.LIVE_SQL}
    SELECT CAST(id AS INTEGER) AS id, "deviceId" AS name, "eventId" AS "add" FROM live""",
)
def _small_batch(spark, folder):
    path = shared_folder(spark, "small-batch")

    def shape(df):
        lines = df.select(
            F.concat_ws(",", "id", "deviceId", "eventId").alias("value")
        )
        return parse_delimited(lines, TEST_LINE)

    rows = _event_stream(spark, folder)
    _run(rows, tables.table_writer(f"{path}/rows", shape), path)
    return tables.read_table(spark, f"{path}/rows", shape(rows).schema).drop("batch")


@query(
    "sink_committed_files",
    f"""WITH {inputs.LIVE_SQL}
    SELECT id, "deviceId", "eventId", "timestamp", "isNew" FROM live""",
)
def _committed(spark, folder):
    """Files that appear batch by batch through the sink's commit protocol."""
    spark.dataSource.register(CommittedFiles)
    path = shared_folder(spark, "committed")
    rows = _event_stream(spark, folder).select("id", "deviceId", "eventId", "timestamp", "isNew")
    writer = rows.writeStream.format("committed_files").option("path", f"{path}/rows")
    finish(writer, f"{path}/checkpoint")
    return read_published(spark, f"{path}/rows", rows.schema)


DETAIL_SQL = PLACED_SQL.format(
    rows="visits",
    columns='anchor_id, "deviceId", "eventId", "osName" AS os, province,'
    f' "releaseChannel" AS channel, "deviceType", "timestamp" AS event_ms, {DATE_HOUR}',
)


def _detail_columns(table):
    return table.withColumn("event_ms", F.unix_millis("eventTime")).drop("eventTime", "processTime", "batch")


DETAIL_KEYS = ("date", "hour", "id")


@query("sink_anchor_detail_upsert", DETAIL_SQL)
def _anchor_detail(spark, folder):
    """Each batch arrives again under another number; readers see one row per id."""
    path = shared_folder(spark, "anchor-detail")
    rows = _placed(spark, folder, filters.room_visits(_event_stream(spark, folder)))
    schema = tables.anchor_detail_rows(rows).schema
    table = ManifestTable(spark, f"{path}/table", schema, DETAIL_KEYS, ["processTime"])
    append = table.writer(tables.anchor_detail_rows)

    def write(batch, batch_id):
        append(batch, 2 * batch_id)
        append(batch, 2 * batch_id + 1)

    _run(rows, write, path)
    return _detail_columns(table.read())


SNAPSHOT_SQL = f"""WITH states AS ({_snapshot_sql("running", "s", inputs.DAY // 4)}),
    newest AS (
      SELECT *, row_number() OVER (PARTITION BY anchor_date ORDER BY bucket_start DESC) AS r
      FROM states)
    SELECT anchor_date AS key, uv || ',' || pv || ',' || online AS value
    FROM newest WHERE r = 1"""


@query("sink_keyed_snapshot", SNAPSHOT_SQL)
def _keyed_snapshot(spark, folder):
    path = shared_folder(spark, "keyed-snapshot")
    visits = filters.room_visits(
        inputs.live_events(inputs.table(spark, folder, "events"))
    )
    pairs = tables.snapshot_pairs(audience_snapshot(visits, every="6 hours"))
    write = tables.table_writer(f"{path}/rows")
    write(pairs, 0)
    write(pairs, 0)
    table = tables.read_table(spark, f"{path}/rows", pairs.schema)
    return tables.latest_snapshot(table)


@query(
    "sink_multi",
    f"""WITH details AS ({DETAIL_SQL}), states AS ({SNAPSHOT_SQL})
    SELECT 'detail' AS output, anchor_id || '-' || id AS key, date || hour AS value FROM details
    UNION ALL SELECT 'snapshot', key, value FROM states""",
)
def _multi(spark, folder):
    """Detail and snapshot from one pass over each batch; snapshots add up over batches."""
    path = shared_folder(spark, "multi")
    visits = filters.room_visits(_event_stream(spark, folder))
    scope = ("anchor_id", "entered")
    rows = marked(visits.select("anchor_id", "deviceId", "timestamp", "id", "entered"), "deviceId", scope)

    def flagged(batch):
        return flagged_batch(batch, "deviceId", scope)

    def detail(batch):
        return visit_detail(batch).select("id", "anchor_id", "date", "hour")

    def increments(batch):
        return snapshot_increments(batch, every="6 hours")

    writer = tables.multi_writer(
        (detail, tables.table_writer(f"{path}/detail")),
        (increments, tables.table_writer(f"{path}/increments")),
    )
    _run(rows, tables.held(lambda batch, batch_id: writer(flagged(batch), batch_id)), path)
    empty = flagged(spark.createDataFrame([], rows.schema))
    details = tables.read_table(spark, f"{path}/detail", detail(empty).schema)
    added = tables.read_table(spark, f"{path}/increments", increments(empty).schema)
    states = tables.latest_snapshot(tables.snapshot_pairs(snapshot_from_increments(added)))
    return details.select(
        F.lit("detail").alias("output"),
        F.concat_ws("-", "anchor_id", "id").alias("key"),
        F.concat("date", "hour").alias("value"),
    ).unionByName(states.select(F.lit("snapshot").alias("output"), "key", "value"))
