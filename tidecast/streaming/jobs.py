"""The platform's standing jobs, from Kafka-shaped records to a batch writer.

Every function returns a writer that is ready but for its checkpoint folder,
trigger and ``start()``::

    records = read_kafka(spark, conf)
    job = jobs.user_counts(records, table_writer("/lake/user-counts"))
    job.option("checkpointLocation", "/lake/checkpoints/user-counts").start()

``write(batch, batch_id)`` is any ``foreachBatch`` function, such as
:func:`sinks.tables.table_writer` or :func:`sinks.tables.jdbc_writer`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.columns import date_text, hour_text
from ..operators import audience, filters, gifts, orders, products, users
from ..operators.location import enrich_location
from ..schemas import (
    CATEGORY_LINE,
    GROUP_DETAIL_LINE,
    GROUP_MAIN_LINE,
    GROUP_ORDER_LINE,
    ORDER_DETAIL,
    ORDER_MAIN,
)
from ..sinks import tables
from ..sinks.tables import BatchWriter
from ..sources.dimension import with_fresh_dimension
from ..sources.json_records import checked_events, parse_cdc, parse_events, rejecting_writer
from ..sources.records import parse_delimited, record_values, with_record_id
from . import as_of, carried, processors
from .first_seen import flagged_batch, marked

#: A device's enters and leaves of a room are told apart.
ENTERS = ("anchor_id", "entered")


def _events(records: DataFrame) -> DataFrame:
    return parse_events(with_record_id(records), id_column="id")


def _visits(records: DataFrame) -> DataFrame:
    return filters.room_visits(_events(records))


def _each(stream: DataFrame, write: BatchWriter, mode: str = "append") -> DataStreamWriter:
    return stream.writeStream.outputMode(mode).foreachBatch(write)


def clean_events(records: DataFrame) -> DataStreamWriter:
    """Parsed events on the console."""
    return tables.console(_events(records))


def user_events(
    records: DataFrame, regions: DataFrame, write: BatchWriter, tz: str | None = None
) -> DataStreamWriter:
    """Located events with date and hour, as rows of the user-event table."""
    placed = enrich_location(_events(records), regions).withColumns(
        {"date": date_text("timestamp", tz), "hour": hour_text("timestamp", tz)}
    )
    return _each(
        placed, lambda batch, n: write(tables.user_event_rows(batch), n)
    )


def user_counts(
    records: DataFrame,
    write: BatchWriter,
    keys: tuple[str, ...] = ("deviceType", "isNew"),
) -> DataStreamWriter:
    """Launches per key; each batch writes the counts it changed."""
    launches = filters.app_launches(_events(records))
    return _each(users.count_users(launches, keys), write, "update")


def user_counts_by_province(
    records: DataFrame, regions: DataFrame, write: BatchWriter
) -> DataStreamWriter:
    """Launches per province and new-user mark."""
    launches = enrich_location(filters.app_launches(_events(records)), regions)
    return _each(users.count_users(launches, ["province", "isNew"]), write, "update")


def new_users(records: DataFrame, write: BatchWriter) -> DataStreamWriter:
    """Launches with a first-seen mark per device type."""
    launches = filters.app_launches(_events(records))
    return _each(
        marked(launches), tables.held(lambda batch, n: write(flagged_batch(batch), n))
    )


def new_users_by_channel(
    records: DataFrame, write: BatchWriter, state: str | None = None
) -> DataStreamWriter:
    """Launches with a first-seen mark and the channel's count of new users.

    With a folder for ``state``, counts are carried there from batch to batch and a
    channel's launches are spread over tasks; without one each channel is a Python state.
    """
    launches = filters.app_launches(_events(records))
    if state is None:
        return _each(processors.count_first_seen_stream(launches), write)
    return _each(marked(launches, scope=()), carried.first_seen_count_batches(state, write))


def room_audience(
    records: DataFrame,
    write: BatchWriter,
    ttl_hours: float | None = processors.STATE_TTL_HOURS,
    evict_delay: str | int | None = None,
    state: str | None = None,
) -> DataStreamWriter:
    """Running visitors, visits and people online per room.

    With a lifetime, ``evict_delay`` deletes spent state. Without one, a folder for
    ``state`` lets totals be carried there, and a crowded room is spread over tasks.
    """
    if state is None:
        counted = processors.audience_stream(
            _visits(records), ttl_hours=ttl_hours, evict_delay=evict_delay
        )
        return _each(counted, write)
    if ttl_hours is not None:
        raise ValueError("carried totals have no lifetime")
    visits = _visits(records).select("anchor_id", "deviceId", "timestamp", "id", "entered")
    return _each(marked(visits, "deviceId", ENTERS), carried.audience_batches(state, write))


def room_detail_and_snapshot(
    records: DataFrame,
    regions: DataFrame,
    write_detail: BatchWriter,
    write_increments: BatchWriter,
    every: str | int = "10 seconds",
    tz: str | None = None,
) -> DataStreamWriter:
    """Located visits for the detail table and increments for the snapshots.

    The increments table gives the snapshots with
    :func:`audience.snapshot_from_increments`.
    """
    placed = enrich_location(_visits(records), regions)
    rows = marked(audience.visit_detail(placed, tz), "deviceId", ENTERS)
    both = tables.multi_writer(
        (tables.anchor_detail_rows, write_detail),
        (lambda b: audience.snapshot_increments(b, every), write_increments),
    )
    return _each(
        rows, tables.held(lambda batch, n: both(flagged_batch(batch, "deviceId", ENTERS), n))
    )


def room_popularity(
    records: DataFrame,
    write: BatchWriter,
    min_stay: str | int = "60 seconds",
    revisit_gap: str | int = "30 minutes",
) -> DataStreamWriter:
    """Enters that count towards a room's popularity, as they become certain."""
    entries = processors.popular_entries_stream(_visits(records), min_stay, revisit_gap)
    return _each(entries, write)


def reward_points(
    records: DataFrame, read_gifts: Callable[[], DataFrame], write: BatchWriter
) -> DataStreamWriter:
    """Points each batch adds per room; the gift table is read anew every time."""
    rewards = gifts.reward_gifts(filters.rewards(_events(records)))

    def work(batch: DataFrame, gift_table: DataFrame, number: int) -> None:
        write(gifts.gift_points_by_anchor(batch, gift_table), number)

    return _each(
        rewards.select("anchor_id", "gift_id"), with_fresh_dimension(read_gifts, work)
    )


def reward_points_as_of(
    records: DataFrame, changes: DataFrame, state: str, write: BatchWriter
) -> DataStreamWriter:
    """Rewards with the gift version of their time.

    ``changes`` is a stream of gift versions, such as the polled table source gives, with
    the time of the change in ms. Versions are carried below ``state``.
    """
    rewards = gifts.reward_gifts(filters.rewards(_events(records)))
    columns = ("id", "timestamp", "anchor_id", "gift_id")
    rows = as_of.tagged(rewards.select(*columns), changes.select(*as_of.CHANGE))
    return _each(rows, as_of.gift_points_batches(state, write, rows.schema, columns))


def stored_events(
    records: DataFrame, write: BatchWriter, write_rejected: BatchWriter
) -> DataStreamWriter:
    """Parsed events to one writer, records that are none to another, with the reason."""
    checked = checked_events(with_record_id(records), id_column="id")
    return _each(checked, rejecting_writer(write, write_rejected))


def hot_products(
    records: DataFrame,
    write: BatchWriter,
    size: str | int = "10 minutes",
    slide: str | int = "1 minute",
    delay: str | int = "5 seconds",
    n: int = 3,
) -> DataStreamWriter:
    """Top products per category, event and sliding window, as windows close."""
    events = filters.product_events(_events(records))
    counts = products.sliding_count(events, products.PRODUCT_KEYS, size, slide, delay)
    return _each(counts, lambda batch, i: write(products.top_n(batch, n=n), i))


def order_details(records: DataFrame) -> DataFrame:
    """Details of captured changes with their time in ms."""
    details = parse_cdc(record_values(records), ORDER_DETAIL)
    return details.select(
        "id", "order_id", "category_id", "sku", "money", "amount",
        F.col("type").alias("detail_type"),
        F.unix_millis("update_time").alias("update_ms"),
    )


def matched_orders(
    detail_records: DataFrame,
    main_records: DataFrame,
    read_orders: Callable[[], DataFrame],
    write: BatchWriter,
    size: str | int = "5 seconds",
    delay: str | int = "2 seconds",
) -> DataStreamWriter:
    """Details with their order, from the window or else from the order table.

    Details that arrive after their window has closed are dropped by the join;
    :func:`orders.rescue_dropped` finds and fills them.
    """
    mains = parse_cdc(record_values(main_records), ORDER_MAIN).select(
        "oid", "total_money", "status", "uid", "province",
        F.col("type").alias("main_type"),
        F.unix_millis("update_time").alias("main_update_ms"),
    )
    joined = orders.windowed_left_join(
        order_details(detail_records), mains, "order_id", "oid", size, delay,
        right_ts="main_update_ms",
    )

    def work(batch: DataFrame, table: DataFrame, number: int) -> None:
        write(orders.lookup_fill(batch, table), number)

    return _each(joined, with_fresh_dimension(read_orders, work))


def group_purchases(
    details: DataFrame,
    paid: DataFrame,
    groups: DataFrame,
    write: BatchWriter,
    size: str | int = "5 seconds",
    delay: str | int = "0 seconds",
) -> DataStreamWriter:
    """Group-purchase lines of three streams, matched window by window."""
    joined = orders.group_buy(
        parse_delimited(details, GROUP_DETAIL_LINE),
        parse_delimited(paid, GROUP_ORDER_LINE),
        parse_delimited(groups, GROUP_MAIN_LINE),
        size,
        delay,
    )
    return _each(joined, write)


def category_totals(lines: DataFrame, write: BatchWriter) -> DataStreamWriter:
    """Quantity per category from ``category-quantity`` lines."""
    rows = parse_delimited(lines, CATEGORY_LINE, sep="-")
    totals = rows.groupBy("category").agg(F.sum("quantity").alias("total"))
    return _each(totals, write, "update")
