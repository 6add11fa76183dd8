"""Streaming forms, run over the test tables as file streams."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ..operators import audience, filters, gifts, orders, products, users
from ..session import shared_folder
from ..sinks import tables
from ..sources.dimension import PolledDimension, with_fresh_dimension
from ..sources.json_records import checked_events, rejecting_writer
from ..streaming import as_of, carried, processors
from ..streaming.bloom import bloom_flag_batches
from ..streaming.first_seen import flagged_batch, marked
from ..streaming.late import late_splitter, with_on_time_keys
from ..streaming.orders import order_filler, order_stream
from ..streaming.runs import append_to_table, batches_to_table, finish, run_batches, stream_files
from ..streaming.window_joins import arrived, finish_windows, window_joined
from . import inputs
from .audience import AUDIENCE_SQL, _snapshot_sql, entries_sql
from .orders import DELAY, DELAY_MS, order_table
from .gifts import AS_OF_SQL, GIFT_POINTS_SQL, live_gifts, rewards_of, shown_points, timed_rewards_of
from .products import (
    SIZE,
    SIZE_MS,
    SLIDE,
    SLIDE_MS,
    TUMBLING_SQL,
    counts_sql,
    shop_rows,
    top_sql,
)
from .records import REJECTED_SQL, doubtful_records
from .registry import query
from .users import (
    ACTIVITY_SQL,
    COUNT_NEW_SQL,
    IS_NEW_SQL,
    LAUNCHES_SQL,
    PV_UV_SQL,
    RUNNING_SUM_SQL,
    activity_rows_of,
    category_rows,
)


def _events(spark, folder):
    return inputs.live_events(inputs.table_stream(spark, folder, "events"))


def _launches(spark, folder, *columns):
    return filters.app_launches(_events(spark, folder)).select(
        "id", "timestamp", "deviceId", *columns
    )


@query(
    "stream_users_by_device_type",
    f"""WITH {LAUNCHES_SQL}
    SELECT "deviceType", "isNew", count(*) AS users FROM launches GROUP BY ALL""",
)
def _users(spark, folder):
    """Each batch writes the counts it changed; the last one per key stands."""
    keys = ["deviceType", "isNew"]
    counts = users.count_users(_launches(spark, folder, *keys), keys)
    table = batches_to_table(counts, "stream-users", output_mode="update")
    return tables.latest_by(table, keys, ["batch"]).drop("batch")


@query(
    "stream_users_total_by_is_new",
    f"""WITH {LAUNCHES_SQL} SELECT "isNew", count(*) AS users FROM launches GROUP BY ALL""",
)
def _users_total(spark, folder):
    """Both levels: batches write the counts they changed, totals add the newest of each."""
    keys = ["deviceType", "isNew"]
    counts = users.count_users(_launches(spark, folder, *keys), keys)
    table = batches_to_table(counts, "stream-totals", output_mode="update")
    return users.total_users(tables.latest_by(table, keys, ["batch"]).drop("batch"))


@query(
    "stream_activity_pv_uv",
    f"""WITH {ACTIVITY_SQL}
    SELECT activity, event, count(DISTINCT uid) AS uv, count(*) AS pv
    FROM activity_rows GROUP BY ALL""",
)
def _activity(spark, folder):
    """Batches add visits and first visits; state is spread over users."""
    rows = activity_rows_of(inputs.table_stream(spark, folder, "events"))
    scope = ("activity", "event")
    increments = batches_to_table(
        marked(rows, "uid", scope),
        "stream-activity",
        shape=lambda batch: flagged_batch(batch, "uid", scope).groupBy(*scope).agg(
            F.sum("isN").alias("uv"), F.count("*").alias("pv")
        ),
    )
    return increments.groupBy("activity", "event").agg(
        F.sum("uv").alias("uv"), F.sum("pv").alias("pv")
    )


@query("stream_activity_pv_uv_approx", PV_UV_SQL)
def _activity_approx(spark, folder):
    """A sketch per batch and key; sketches of all batches are merged on reading."""
    rows = activity_rows_of(inputs.table_stream(spark, folder, "events"))
    sketches = batches_to_table(rows, "stream-activity-approx", shape=users.visit_sketches)
    return users.sketched_pv_uv(sketches)


@query(
    "stream_is_new_user_bloom",
    f"""WITH {LAUNCHES_SQL}
    SELECT id, "timestamp", "deviceId",
           CAST(CASE WHEN row_number() OVER (PARTITION BY "deviceId" ORDER BY "timestamp", id) = 1
                     THEN 1 ELSE 0 END AS INTEGER) AS "isN"
    FROM launches""",
)
def _is_new_bloom(spark, folder):
    """By a filter that is carried from batch to batch; so few devices share no bits."""
    return run_batches(
        _launches(spark, folder), "stream-bloom", bloom_flag_batches,
        "id bigint, timestamp bigint, deviceId string, isN int",
    )


@query("stream_is_new_user_by_device_type", IS_NEW_SQL)
def _is_new(spark, folder):
    """Spark's own deduplication tells new devices; no Python state."""
    rows = marked(_launches(spark, folder, "deviceType"))
    return batches_to_table(rows, "stream-is-new", shape=flagged_batch).drop("batch")


@query("stream_new_user_count_by_channel", COUNT_NEW_SQL)
def _count_new(spark, folder):
    """New devices by deduplication, counts per channel carried from batch to batch."""
    rows = marked(_launches(spark, folder, "releaseChannel"), scope=())
    columns = (
        'id bigint, timestamp bigint, deviceId string, releaseChannel string, "isN" int, "perCnt" int'
    )
    return run_batches(
        rows, "stream-count-new", carried.first_seen_count_batches, columns.replace('"', "")
    )


VISIT_COLUMNS = ("anchor_id", "deviceId", "timestamp", "id", "entered")


@query("stream_audience_uv_pv_online", AUDIENCE_SQL)
def _audience(spark, folder):
    """Totals per room are carried from batch to batch; a batch is summed in chunks."""
    visits = filters.room_visits(_events(spark, folder))
    return run_batches(
        marked(visits.select(*VISIT_COLUMNS), "deviceId", ("anchor_id", "entered")),
        "stream-audience",
        carried.audience_batches,
        "id bigint, timestamp bigint, anchor_id string, uv bigint, pv bigint, online bigint",
    )


TTL_HOURS = 6
TTL_SQL = f"""WITH {inputs.VISITS_SQL},
    marks AS (
      SELECT *, CASE WHEN entered = 1 AND coalesce("timestamp" - lag("timestamp") OVER (
                   PARTITION BY anchor_id, "deviceId", entered ORDER BY "timestamp", id)
                   >= {TTL_HOURS * 3_600_000}, true) THEN 1 ELSE 0 END AS first_visit,
             CASE WHEN "timestamp" - lag("timestamp") OVER (
                   PARTITION BY anchor_id ORDER BY "timestamp", id) >= {TTL_HOURS * 3_600_000}
             THEN 1 ELSE 0 END AS starts
      FROM visits),
    lives AS (
      SELECT *, sum(starts) OVER (PARTITION BY anchor_id ORDER BY "timestamp", id
                                  ROWS UNBOUNDED PRECEDING) AS life
      FROM marks)
    SELECT id, "timestamp", anchor_id, CAST(sum(first_visit) OVER w AS BIGINT) AS uv,
           CAST(sum(entered) OVER w AS BIGINT) AS pv,
           CAST(sum(2 * entered - 1) OVER w AS BIGINT) AS online
    FROM lives
    WINDOW w AS (PARTITION BY anchor_id, life ORDER BY "timestamp", id ROWS UNBOUNDED PRECEDING)"""


@query("stream_audience_ttl", TTL_SQL)
def _audience_ttl(spark, folder):
    """With the default lifetime; rooms and devices are forgotten by event time.

    Timers delete what is spent. Rows come in order of time but for those of a batch.
    """
    visits = filters.room_visits(_events(spark, folder))
    counted = processors.audience_stream(
        visits, floor_at_zero=False, ttl_hours=TTL_HOURS, evict_delay="1 hour"
    )
    return append_to_table(counted, "stream-audience-ttl")


@query("stream_audience_snapshot", _snapshot_sql("running", "s", inputs.DAY // 4))
def _snapshot(spark, folder):
    """Batches add their increments to a table; its sums are the rooms' states."""
    visits = filters.room_visits(_events(spark, folder))
    scope = ("anchor_id", "entered")
    increments = batches_to_table(
        marked(visits.select(*VISIT_COLUMNS), "deviceId", scope),
        "stream-snapshot",
        shape=lambda batch: audience.snapshot_increments(
            flagged_batch(batch, "deviceId", scope), "6 hours"
        ),
    )
    return audience.snapshot_from_increments(increments)


def _closed_sql(min_stay: int, gap: int) -> str:
    # An enter still waiting when the stream ends is not decided yet.
    return f"""WITH {entries_sql(min_stay, gap)}
    SELECT anchor_id, count(*) AS popularity FROM (
      SELECT e.* FROM entries e JOIN sides s USING (id)
      WHERE s.n IS NOT NULL
         OR e."timestamp" + {min_stay} <= (SELECT max("timestamp") FROM visits) - 5000)
    GROUP BY ALL"""


@query("stream_popularity", _closed_sql(inputs.DAY // 4, 3 * inputs.DAY))
def _popularity(spark, folder):
    visits = filters.room_visits(_events(spark, folder))
    entries = processors.popular_entries_stream(visits, "6 hours", "3 days")
    table = append_to_table(entries, "stream-popularity")
    return table.groupBy("anchor_id").agg(F.count("*").alias("popularity"))


@query(
    "stream_popularity_entries",
    f"""WITH {entries_sql(inputs.DAY // 4, 3 * inputs.DAY)}
    SELECT e.anchor_id, e."deviceId", e."timestamp", 'live-' || e.id AS id
    FROM entries e JOIN sides s USING (id)
    WHERE s.n IS NOT NULL
       OR e."timestamp" + {inputs.DAY // 4} <= (SELECT max("timestamp") FROM visits) - 5000""",
)
def _popular_entries(spark, folder):
    """The entries themselves, under text ids as records have them."""
    visits = filters.room_visits(_events(spark, folder)).withColumn(
        "id", F.concat(F.lit("live-"), "id")
    )
    entries = processors.popular_entries_stream(visits, "6 hours", "3 days")
    return append_to_table(entries, "stream-entries")


@query("stream_category_running_sum", RUNNING_SUM_SQL)
def _running_sum(spark, folder):
    rows = category_rows(inputs.table_stream(spark, folder, "events"))
    return run_batches(
        rows, "stream-sum", carried.running_sum_batches,
        "category string, timestamp bigint, id bigint, total bigint",
    )


@query(
    "stream_exactly_once",
    f"""WITH {inputs.LIVE_SQL} SELECT id, "deviceId", "eventId", "timestamp" FROM live""",
)
def _exactly_once(spark, folder):
    """The job fails between writing a batch and committing it, and starts again."""
    path = shared_folder(spark, "stream-once")
    rows = _events(spark, folder).select("id", "deviceId", "eventId", "timestamp")
    write = tables.table_writer(f"{path}/rows")

    def failing(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 2:
            raise RuntimeError("lost between write and commit")

    try:
        finish(rows.writeStream.foreachBatch(failing), f"{path}/checkpoint")
        raise AssertionError("the job was to fail")
    except StreamingQueryException:
        finish(rows.writeStream.foreachBatch(write), f"{path}/checkpoint")
    return tables.read_table(spark, f"{path}/rows", rows.schema).drop("batch")


@query("stream_rejected_records", REJECTED_SQL)
def _rejected(spark, folder):
    """Kept rows in one table, rejected records with their reason in another."""
    path = shared_folder(spark, "stream-rejected")
    raw = doubtful_records(inputs.raw_records(inputs.table_stream(spark, folder, "events")))
    checked = checked_events(raw.select("id", "value"), id_column="id")
    writer = rejecting_writer(
        tables.table_writer(f"{path}/kept"), tables.table_writer(f"{path}/rejected")
    )
    finish(checked.writeStream.foreachBatch(writer), f"{path}/checkpoint")
    kept = spark.read.parquet(f"{path}/kept").select("id", F.lit(True).alias("kept"))
    rejected = spark.read.parquet(f"{path}/rejected").select("id", F.lit(False).alias("kept"), "reason")
    return kept.withColumn("reason", F.lit(None).cast("string")).unionByName(rejected)


CLOSED = '"windowEnd" <= (SELECT max("timestamp") FROM shop) - 5000'


def _shop_counts(spark, folder):
    shop = shop_rows(inputs.table_stream(spark, folder, "events"))
    return products.sliding_count(shop, size=SIZE, slide=SLIDE)


@query(
    "stream_product_sliding_count",
    f"WITH {counts_sql(SIZE_MS, SLIDE_MS)} SELECT * FROM counts WHERE {CLOSED}",
)
def _sliding(spark, folder):
    return append_to_table(_shop_counts(spark, folder), "stream-sliding")


@query(
    "stream_tumbling_event_count",
    f"WITH {TUMBLING_SQL} SELECT * FROM counts WHERE {CLOSED}",
)
def _tumbling(spark, folder):
    shop = shop_rows(inputs.table_stream(spark, folder, "events"))
    counts = products.sliding_count(shop, ["eventId"], "1 day", "1 day")
    return append_to_table(counts, "stream-tumbling")


@query(
    "stream_product_top3",
    f"WITH {top_sql(SIZE_MS, SLIDE_MS)} SELECT * FROM ranked WHERE rank <= 3 AND {CLOSED}",
)
def _top3(spark, folder):
    """A window's counts all appear in the batch that closes it, and are ranked there."""
    table = batches_to_table(
        _shop_counts(spark, folder), "stream-top3", shape=products.top_n
    )
    return table.drop("batch")


# A list is told once the watermark has passed the instant behind its window.
TIMED = '"windowEnd" + 1 <= (SELECT max("timestamp") FROM shop) - 5000'


@query(
    "stream_product_top3_timer",
    f"WITH {top_sql(SIZE_MS, SLIDE_MS)} SELECT * FROM ranked WHERE rank <= 3 AND {TIMED}",
)
def _top3_timer(spark, folder):
    """Lists in state behind the window counts, told by timers."""
    top = processors.top_products_stream(_shop_counts(spark, folder))
    return append_to_table(top, "stream-top3-timer")


JOIN_CLOSED_SQL = f"""WITH {inputs.ORDERS_SQL},
    mark AS (
      SELECT least((SELECT max(main_update_ms) FROM mains),
                   (SELECT max(update_ms) FROM details)) - 2000 AS wm)
    SELECT order_id, line, sku, money, update_ms, "windowStart", oid, total_money,
           main_update_ms
    FROM details LEFT JOIN mains ON order_id = oid AND "windowStart" = main_window
    WHERE oid IS NOT NULL OR "windowStart" + {inputs.ORDER_WINDOW_MS} <= (SELECT wm FROM mark)"""


@query("stream_order_detail_left_join", JOIN_CLOSED_SQL)
def _order_join(spark, folder):
    """Open windows are carried from batch to batch and joined as tables."""
    lines = inputs.order_detail(inputs.table_stream(spark, folder, "lineitem"))
    mains = inputs.order_main(inputs.table_stream(spark, folder, "orders"))
    joined = window_joined(
        {
            "details": lines.select("order_id", "line", "sku", "money", "update_ms"),
            "mains": mains.select("oid", "total_money", "main_update_ms"),
        },
        {"details": "update_ms", "mains": "main_update_ms"},
        "stream-orders",
        lambda d, m: orders.windowed_left_join(
            d, m, "order_id", "oid", size=inputs.ORDER_WINDOW, right_ts="main_update_ms"
        ),
        size=inputs.ORDER_WINDOW,
    )
    columns = (
        "order_id line sku money update_ms windowStart oid total_money main_update_ms"
    )
    return joined.select(*columns.split())


# Rows of both sides come in four portions of the time in which details arrive. Spark takes
# rows as late by the watermark under which the previous batch ran.
PORTION_SQL = "least(3, greatest(0, ({time} - lo) * 4 // (hi - lo + 1)))"
STREAM_FILL_SQL = f"""WITH {inputs.ORDERS_SQL},
    span AS (SELECT min(arrival) AS lo, max(arrival) AS hi FROM details),
    dp AS (SELECT d.*, {PORTION_SQL.format(time="arrival")} AS p FROM details d, span),
    mp AS (SELECT m.*, {PORTION_SQL.format(time="main_update_ms")} AS p FROM mains m, span),
    tops AS (
      SELECT p, least((SELECT max(update_ms) FROM dp WHERE dp.p <= t.p),
                      (SELECT max(main_update_ms) FROM mp WHERE mp.p <= t.p)) - {DELAY_MS} AS wm
      FROM range(0, 4) t(p)),
    marked AS (
      SELECT dp.*, coalesce("windowStart" + {inputs.ORDER_WINDOW_MS} <= wm, false) AS is_late
      FROM dp LEFT JOIN tops ON tops.p = dp.p - 2)
    SELECT order_id, line, sku, update_ms,
           CASE WHEN NOT is_late THEN "windowStart" END AS "windowStart",
           j.oid, coalesce(j.total_money, l.total_money) AS total_money,
           CASE WHEN j.oid IS NOT NULL THEN 'joined' WHEN l.oid IS NOT NULL THEN 'lookup'
                ELSE 'none' END AS main_source
    FROM marked
    LEFT JOIN mains j ON order_id = j.oid AND "windowStart" = j.main_window AND NOT is_late
    LEFT JOIN mains l ON order_id = l.oid AND j.oid IS NULL
    WHERE is_late OR j.oid IS NOT NULL
       OR "windowStart" + {inputs.ORDER_WINDOW_MS} <= (SELECT wm FROM tops WHERE p = 3)"""


@query("stream_order_lookup_fill", STREAM_FILL_SQL)
def _order_fill(spark, folder):
    """Windows, late details and the order table in one job; open windows are carried."""
    path = shared_folder(spark, "stream-fill")
    details = inputs.arriving_details(inputs.table(spark, folder, "lineitem"))
    mains = inputs.order_main(inputs.table(spark, folder, "orders"))
    low, high = details.agg(F.min("arrival"), F.max("arrival")).first()
    ids = ("order_id", "line", "sku", "update_ms")
    sides = {}
    for name, rows, at in (
        ("details", details.select(*ids, "arrival"), "arrival"),
        ("mains", mains, "main_update_ms"),
    ):
        portion = F.floor((F.col(at) - low) * inputs.BATCHES / (high - low + 1))
        portion = F.least(F.lit(inputs.BATCHES - 1), F.greatest(F.lit(0), portion))
        files = inputs.write_portions(rows, portion, f"{path}/{name}")
        like = rows.drop("arrival")
        sides[name] = stream_files(spark, like, f"{path}/{name}", "*.parquet", files)
    filler = order_filler(
        f"{path}/state",
        lambda: order_table(spark, folder),
        tables.table_writer(f"{path}/rows"),
        {name: side.schema for name, side in sides.items()},
        ids, inputs.ORDER_WINDOW, DELAY,
    )
    finish_windows(order_stream(**sides), filler, f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/rows").select(
        "order_id", "line", "sku", "update_ms", "windowStart", "oid", "total_money", "main_source"
    )


@query("stream_gift_points_as_of", AS_OF_SQL)
def _gift_points_as_of(spark, folder):
    """Changes and rewards arrive as one stream; versions are carried to later batches."""
    path = shared_folder(spark, "stream-as-of")
    rows = as_of.tagged(
        timed_rewards_of(inputs.table(spark, folder, "events")), inputs.gift_versions(spark, folder)
    ).withColumn("at", F.coalesce("timestamp", "updateTime"))
    cuts = [inputs.CHANGES_FROM + i * inputs.CHANGE_STEPS // 4 * inputs.CHANGE_STEP for i in (1, 2, 3)]
    portion = sum(((F.col("at") > cut).cast("int") for cut in cuts), F.lit(0))
    files = inputs.write_portions(rows, portion, f"{path}/arrived")
    stream = stream_files(spark, rows, f"{path}/arrived", "*.parquet", files)
    points = run_batches(
        stream, "stream-as-of-rows",
        lambda state, write: as_of.gift_points_batches(
            state, write, rows.schema, ("id", "timestamp", "anchor_id", "gift_id"), tie=("change",)
        ),
        "id bigint, timestamp bigint, anchor_id string, gift_id int, gift_name string, points double",
    )
    return shown_points(points)


@query("stream_gift_points", GIFT_POINTS_SQL)
def _gift_points(spark, folder):
    """The gift table is read anew for every batch."""
    path = shared_folder(spark, "stream-gifts")
    write = tables.table_writer(f"{path}/rows")

    def work(batch, gift_table, batch_id):
        write(gifts.gift_points(batch, gift_table), batch_id)

    stream = rewards_of(inputs.table_stream(spark, folder, "events"))
    each = with_fresh_dimension(lambda: live_gifts(spark, folder), work)
    finish(stream.writeStream.foreachBatch(each), f"{path}/checkpoint")
    like = gifts.gift_points(
        spark.createDataFrame([], stream.schema), live_gifts(spark, folder)
    )
    table = tables.read_table(spark, f"{path}/rows", like.schema)
    return table.select(
        "id", "anchor_id", "gift_id", "gift_name", F.round("points", 2).alias("points")
    )


@query(
    "stream_dimension_poll",
    f"WITH {inputs.GIFTS_SQL} SELECT id, name, points, deleted FROM gifts",
)
def _polled(spark, folder):
    """A poll per micro-batch while the changes come in; each reads what is new."""
    path = shared_folder(spark, "polled-gifts")
    changes = inputs.gift_changes(spark, folder)
    last = changes.agg(F.max("updateTime")).first()[0]
    gift_table = PolledDimension(spark, f"{path}/gifts", changes.schema)

    def work(batch, batch_id):
        known = last * (batch_id + 1) // inputs.BATCHES
        gift_table.poll(lambda: changes.where(F.col("updateTime") <= known))

    _run = inputs.table_stream(spark, folder, "events").writeStream.foreachBatch(work)
    finish(_run, f"{path}/checkpoint")
    return gift_table.live().drop("updateTime")


GROUP_CLOSED_SQL = f"""WITH {inputs.GROUPS_SQL},
    mark AS (
      SELECT least((SELECT max(order_ts) FROM group_orders), (SELECT max(ts) FROM members),
                   (SELECT max(group_ts) FROM group_mains)) AS wm)
    SELECT m.ts, m.user_id, m.group_id, m.order_id, m."windowStart", o.order_ts,
           o.order_amount,
           g.group_ts, g.group_category
    FROM members m
    LEFT JOIN group_orders o ON m.order_id = o.order_id AND m."windowStart" = o.w
    LEFT JOIN group_mains g ON m.group_id = g.group_id AND m."windowStart" = g.w
    WHERE (o.w IS NOT NULL AND g.w IS NOT NULL)
       OR m."windowStart" + {inputs.ORDER_WINDOW_MS} <= (SELECT wm FROM mark)"""


@query("stream_group_buy_join", GROUP_CLOSED_SQL)
def _group_buy(spark, folder):
    """Open windows are carried from batch to batch and joined as tables."""
    lineitem = inputs.table(spark, folder, "lineitem")
    opened = shared_folder(spark, "group-mains")
    inputs.group_mains(lineitem).write.parquet(opened)
    mains = spark.read.parquet(opened)
    joined = window_joined(
        {
            "details": inputs.group_details(inputs.table_stream(spark, folder, "lineitem")),
            "orders": inputs.group_orders(inputs.table_stream(spark, folder, "orders")),
            "groups": spark.readStream.schema(mains.schema).parquet(opened),
        },
        {"details": "ts", "orders": "ts", "groups": "ts"},
        "stream-groups",
        lambda d, o, g: orders.group_buy(
            d, o, g, size=inputs.ORDER_WINDOW, along=(arrived("orders"), arrived("groups"))
        ),
        size=inputs.ORDER_WINDOW,
        delay="0 seconds",
    )
    columns = (
        "ts user_id group_id order_id windowStart order_ts order_amount"
        " group_ts group_category"
    )
    return joined.select(*columns.split())


# Events arrive in four portions, some after the portion they belong to.
PORTIONS = 4
STREAM_LATE_SQL = f"""WITH {inputs.LIVE_SQL},
    size AS (SELECT count(*) AS n FROM events),
    portions AS (
      SELECT id, "timestamp",
             (id + (id * 7919) % (n // 4)) * {PORTIONS} // (n + n // 4) AS portion
      FROM live, size),
    highest AS (
      SELECT portion, max("timestamp") AS top FROM portions GROUP BY portion)
    SELECT id, "timestamp",
           coalesce("timestamp" // {inputs.DAY // 4} * {inputs.DAY // 4} + {inputs.DAY // 4}
                    <= (SELECT max(top) FROM highest h WHERE h.portion < p.portion)
                       - 3600000, false) AS is_late
    FROM portions p"""


@query("stream_late_side_output", STREAM_LATE_SQL)
def _late(spark, folder):
    """One portion per run; each run goes on from the checkpoint of the last."""
    path = shared_folder(spark, "stream-late")
    raw = inputs.table(spark, folder, "events")
    n = raw.count()
    shuffled = F.col("id") + (F.col("id") * 7919) % (n // 4)
    portion = F.floor(shuffled * PORTIONS / (n + n // 4))
    rows = inputs.live_events(raw).select("id", "timestamp", portion.alias("portion"))
    kept = rows.drop("portion")
    splitter = late_splitter(
        tables.table_writer(f"{path}/on-time"), tables.table_writer(f"{path}/late")
    )
    for number in range(PORTIONS):
        arrived = rows.where(F.col("portion") == number).drop("portion")
        arrived.write.mode("append").parquet(f"{path}/arrived")
        stream = (
            spark.readStream.schema(kept.schema)
            .option("maxFilesPerTrigger", 1_000_000)
            .parquet(f"{path}/arrived")
        )
        marked_rows = with_on_time_keys(stream, size="6 hours", delay="1 hour")
        finish(marked_rows.writeStream.foreachBatch(splitter), f"{path}/checkpoint")
    on_time = tables.read_table(spark, f"{path}/on-time", kept.schema)
    late = tables.read_table(spark, f"{path}/late", kept.schema)
    return (
        on_time.withColumn("is_late", F.lit(False))
        .unionByName(late.withColumn("is_late", F.lit(True)))
        .drop("batch")
    )
