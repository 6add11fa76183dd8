"""Keyed state where no built-in streaming operator fits.

The rows of a micro-batch reach a processor unordered, so each puts its key's
rows of that batch in (timestamp, id) order first. The source's per-trigger
limit bounds how many there are.

A call and its reads and writes of state cost far more than a row. Where keys are many and
have few rows each, such as visitors, a call serves a share of them, dealt by hash.
"""

from __future__ import annotations

import heapq
import itertools
import pickle
import sys
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (
    StatefulProcessor,
    StatefulProcessorHandle,
)

from ..functions.columns import date_text, duration_ms, event_time

STATE_TTL_HOURS = 6
FOREVER = 2**63 - 1

# Processors travel to the executors with their code, so that the package need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__.split(".")[0]])


#: Visitors are dealt into so many shares, each with one state that holds its visitors'.
SHARES = 512
_SHARE = "_share"


def _place(row: Row) -> tuple:
    # Rows of several visitors may tie without a time or an id; those come first.
    at, row_id = row["timestamp"], row["id"]
    return at is not None, at, row_id is not None, row_id


def _in_order(rows: Iterator[Row]) -> list[Row]:
    return sorted(rows, key=_place)


def _by_share(rows: DataFrame, keys: Sequence[str]):
    """The rows grouped by their keys' share, which is column ``_share``."""
    share = F.pmod(F.xxhash64(*keys), F.lit(SHARES)).cast("int")
    return rows.withColumn(_SHARE, share).groupBy(_SHARE)


def _ttl(hours: float | None) -> int | None:
    return None if hours is None else int(hours * 3_600_000)


class Expiring(StatefulProcessor):
    """Clears spent state by a timer on event time, if ``evict`` is set.

    A key has one timer, at the end of its life. Once the watermark has passed it, only
    rows behind that end can come, for which spent state and none are the same.
    """

    def __init__(self, evict: bool) -> None:
        self.evict = evict

    def move_timer(self, before: int | None, until: int) -> None:
        if self.evict and until != before and until < FOREVER:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.expire(expiredTimerInfo.getExpiryTimeInMs())
        return iter([])

    def expire(self, at: int) -> None:
        raise NotImplementedError

    def close(self) -> None:
        pass


class FirstSeen(Expiring):
    """Sets ``isN`` to 1 on a key's first row and to 0 on the others, for a share of keys.

    With a lifetime a key is forgotten that long after its latest row, by the rows'
    own time: the state holds the time up to which each key counts, and the last of them.
    Without eviction no row is dropped for being old, and a replay gives the same marks
    on any day.
    """

    def __init__(self, keys: Sequence[str], ttl_ms: int | None = None, evict: bool = False) -> None:
        super().__init__(evict)
        self.keys = keys
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "until bigint, kept binary")

    def expire(self, at: int) -> None:
        if self.seen.exists() and self.seen.get()[0] <= at:
            self.seen.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before, kept = None, {}
        if self.seen.exists():
            before, stored = self.seen.get()
            kept = pickle.loads(stored)
        for row in _in_order(rows):
            values = row.asDict()
            del values[_SHARE]
            name = tuple(values[k] for k in self.keys)
            at, until = row["timestamp"], kept.get(name)
            new = until is None or (self.ttl_ms is not None and at >= until)
            values["isN"] = int(new)
            end = FOREVER if self.ttl_ms is None else at + self.ttl_ms
            kept[name] = end if until is None else max(until, end)
            yield Row(**values)
        last = max(kept.values())
        if self.evict:
            # Spent keys go with the next rows of their share, the last one by the timer.
            now = timerValues.getCurrentWatermarkInMs()
            kept = {name: until for name, until in kept.items() if until > now}
        self.move_timer(before, last)
        self.seen.update((last, pickle.dumps(kept)))


class CountNew(StatefulProcessor):
    """Numbers a key's rows with ``isN`` = 1 in ``perCnt``; others get 0."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "count int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        count = self.count.get()[0] if self.count.exists() else 0
        for row in _in_order(rows):
            values = row.asDict()
            count += values["isN"]
            values["perCnt"] = count if values["isN"] else 0
            yield Row(**values)
        self.count.update((count,))

    def close(self) -> None:
        pass


class Audience(Expiring):
    """Running uv, pv and people online of one room, one row per visit.

    ``isN`` of a visit marks a device's first enter. With a lifetime the counters start
    again once a visit comes that long after the room's latest one, by the visits' own
    time.
    """

    def __init__(self, floor_at_zero: bool, ttl_ms: int | None, evict: bool = False) -> None:
        super().__init__(evict)
        self.floor_at_zero = floor_at_zero
        self.ttl_ms = ttl_ms

    def expire(self, at: int) -> None:
        if self.counts.exists() and self.counts.get()[3] <= at:
            self.counts.clear()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState(
            "counts", "uv bigint, pv bigint, online bigint, until bigint"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.counts.get() if self.counts.exists() else (0, 0, 0, None)
        uv, pv, online, until = state
        before = until
        # A crowded room has many rows, of which these are the least.
        visits = ((r["timestamp"], r["id"], r["entered"], r["isN"]) for r in rows)
        for at, row_id, entered, new in sorted(visits, key=lambda v: v[:2]):
            if until is not None and at >= until:
                uv = pv = online = 0
            if entered:
                uv += new
                pv += 1
                online += 1
            else:
                online -= 1
                if self.floor_at_zero:
                    online = max(online, 0)
            end = FOREVER if self.ttl_ms is None else at + self.ttl_ms
            until = end if until is None else max(until, end)
            yield Row(
                id=row_id, timestamp=at, anchor_id=key[0],
                uv=uv, pv=pv, online=online,
            )
        self.move_timer(before, until)
        self.counts.update((uv, pv, online, until))


class AudienceTimer(Audience):
    """State of a room at each aligned interval's end, if the interval had visits."""

    def __init__(self, every_ms: int, ttl_ms: int | None) -> None:
        super().__init__(False, ttl_ms)
        self.every_ms = every_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        self.handle.registerTimer(now - now % self.every_ms + self.every_ms)
        for _ in super().handleInputRows(key, rows, timerValues):
            pass
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self.counts.get() if self.counts.exists() else (0, 0, 0, None)
        uv, pv, online, _ = state
        yield Row(
            anchor_id=key[0],
            fired_at=expiredTimerInfo.getExpiryTimeInMs(),
            uv=uv, pv=pv, online=online,
        )


class Popularity(StatefulProcessor):
    """Emits the enters that count of a share of visitors, each once it is certain.

    An enter waits until the end of its minimum stay. A leave before that cancels it; a
    later leave or the share's timer, which stands at the first such end, confirms it.
    """

    def __init__(self, min_stay_ms: int, revisit_gap_ms: int) -> None:
        self.min_stay_ms = min_stay_ms
        self.revisit_gap_ms = revisit_gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # The timer, and each visitor's last leave and waiting enters' times and ids.
        self.state = handle.getValueState("visitors", "due bigint, kept binary")

    def _load(self) -> tuple[int | None, dict[tuple, tuple[int | None, list[tuple[int, Any]]]]]:
        if not self.state.exists():
            return None, {}
        due, stored = self.state.get()
        return due, pickle.loads(stored)

    def _save(self, before: int | None, kept: dict, now: int) -> None:
        # After the gap a leave decides nothing about rows that the watermark lets pass.
        kept = {
            name: (left, waiting) for name, (left, waiting) in kept.items()
            if waiting or (left is not None and left + self.revisit_gap_ms >= now)
        }
        enters = (w[0] for _, waiting in kept.values() for w in waiting)
        first = min(enters, default=None)
        due = None if first is None else first + self.min_stay_ms
        if due != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if due is not None:
                self.handle.registerTimer(due)
        if kept:
            self.state.update((due, pickle.dumps(kept)))
        else:
            self.state.clear()

    def _counted(self, name: tuple, enters: list[tuple[int, Any]]) -> Iterator[Row]:
        for at, row_id in enters:
            yield Row(anchor_id=name[0], deviceId=name[1], timestamp=at, id=row_id)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        due, kept = self._load()
        for row in _in_order(rows):
            name, at = (row["anchor_id"], row["deviceId"]), row["timestamp"]
            left, waiting = kept.get(name, (None, []))
            if row["entered"]:
                if left is None or at - left > self.revisit_gap_ms:
                    waiting.append((at, row["id"]))
                    kept[name] = left, waiting
                continue
            kept[name] = at if left is None else max(left, at), []
            yield from self._counted(name, [w for w in waiting if at - w[0] >= self.min_stay_ms])
        self._save(due, kept, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # Of all ends the watermark has passed only the first has a timer.
        now, fired = timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()
        last = max(fired, now - 1) - self.min_stay_ms
        _, kept = self._load()
        for name, (left, waiting) in kept.items():
            due = [w for w in waiting if w[0] <= last]
            if due:
                kept[name] = left, [w for w in waiting if w[0] > last]
                yield from self._counted(name, due)
        self._save(None, kept, now)

    def close(self) -> None:
        pass


class TopList(StatefulProcessor):
    """The first ``n`` products of a window, told by a timer right behind its end.

    The list holds no more than ``n`` products, whatever number was counted.
    """

    def __init__(self, n: int) -> None:
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getListState("items", "productId string, count bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [tuple(i) for i in self.items.get()] if self.items.exists() else []
        counted = itertools.chain(held, ((r["productId"], r["count"]) for r in rows))
        self.items.put(heapq.nsmallest(self.n, counted, key=lambda i: (-i[1], i[0])))
        if not held:
            self.handle.registerTimer(key[3] + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        category, event, start, end = key
        for rank, (product, count) in enumerate(self.items.get(), 1):
            yield Row(
                eventId=event, categoryId=category, productId=product, count=count,
                windowStart=start, windowEnd=end, rank=rank,
            )
        self.items.clear()

    def close(self) -> None:
        pass


class RunningSum(StatefulProcessor):
    """Running sum of ``quantity`` per key, one row per input row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getMapState("totals", "category string", "total bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        name = (key[0],)
        total = self.totals.getValue(name)[0] if self.totals.containsKey(name) else 0
        for row in _in_order(rows):
            total += row["quantity"]
            yield Row(
                category=key[0], timestamp=row["timestamp"], id=row["id"], total=total
            )
        self.totals.updateValue(name, (total,))

    def close(self) -> None:
        pass


def _with_column(schema: T.StructType, name: str) -> T.StructType:
    fields = [f for f in schema.fields if f.name != name]
    return T.StructType([*fields, T.StructField(name, T.IntegerType())])


def flag_first_seen_stream(
    df: DataFrame,
    user: str = "deviceId",
    scope: tuple[str, ...] = ("deviceType",),
    ttl_hours: float | None = None,
    evict_delay: str | int | None = None,
) -> DataFrame:
    """Streaming :func:`users.flag_first_seen`: the first row to arrive is new.

    With ``evict_delay``, keys leave the state once the watermark, that long behind the
    latest row, has passed their life. Rows further behind are then dropped, and the
    event time stays as column ``_ts`` for the next keyed step.
    """
    rows, keys = df.drop("isN"), (*scope, user)
    if evict_delay is None or ttl_hours is None:
        return _by_share(rows, keys).transformWithState(
            FirstSeen(keys, _ttl(ttl_hours)), _with_column(rows.schema, "isN"), "Append", "None"
        )
    timed = rows.withColumn("_ts", event_time("timestamp")).withWatermark(
        "_ts", f"{duration_ms(evict_delay)} milliseconds"
    )
    return _by_share(timed, keys).transformWithState(
        FirstSeen(keys, _ttl(ttl_hours), True), _with_column(timed.schema, "isN"), "Append", "EventTime",
        eventTimeColumnName="_ts",
    )


def count_first_seen_stream(
    df: DataFrame, user: str = "deviceId", key: str = "releaseChannel"
) -> DataFrame:
    """Streaming :func:`users.count_first_seen`: two keyed steps in a row."""
    flagged = flag_first_seen_stream(df.drop("perCnt"), user, ())
    return flagged.groupBy(key).transformWithState(
        CountNew(), _with_column(flagged.schema, "perCnt"), "Append", "None"
    )


def audience_stream(
    visits: DataFrame,
    floor_at_zero: bool = True,
    ttl_hours: float | None = STATE_TTL_HOURS,
    evict_delay: str | int | None = None,
) -> DataFrame:
    """Streaming :func:`audience.audience`, with state forgotten after ``ttl_hours``.

    Devices are remembered per room and device, only the counters per room. Both go by
    the visits' own time. With ``evict_delay`` spent state of both is also deleted; see
    :func:`flag_first_seen_stream`.
    """
    id_type = visits.schema["id"].dataType.simpleString()
    evict = evict_delay is not None and ttl_hours is not None
    return (
        flag_first_enters_stream(visits, ttl_hours, evict_delay)
        .groupBy("anchor_id")
        .transformWithState(
            Audience(floor_at_zero, _ttl(ttl_hours), evict),
            f"id {id_type}, timestamp bigint, anchor_id string,"
            " uv bigint, pv bigint, online bigint",
            "Append",
            "EventTime" if evict else "None",
        )
    )


def audience_timer_stream(
    visits: DataFrame,
    every: str | int = "10 seconds",
    ttl_hours: float | None = STATE_TTL_HOURS,
    tz: str | None = None,
) -> DataFrame:
    """Room state on a wall-clock timer, with the key the snapshot table uses."""
    rows = flag_first_enters_stream(visits, ttl_hours)
    states = rows.groupBy("anchor_id").transformWithState(
        AudienceTimer(duration_ms(every), _ttl(ttl_hours)),
        "anchor_id string, fired_at bigint, uv bigint, pv bigint, online bigint",
        "Append",
        "ProcessingTime",
    )
    return states.select(
        F.concat_ws("_", "anchor_id", date_text("fired_at", tz)).alias("anchor_date"),
        "anchor_id",
        F.col("fired_at").alias("bucket_start"),
        "uv",
        "pv",
        "online",
    )


def flag_first_enters_stream(
    visits: DataFrame,
    ttl_hours: float | None = None,
    evict_delay: str | int | None = None,
) -> DataFrame:
    """Visits with ``isN`` 1 on each device's first enter of a room.

    State is spread over devices, so a crowded room is not one task. Feeds
    :func:`audience.snapshot_increments`.
    """
    rows = visits.select("anchor_id", "deviceId", "timestamp", "id", "entered")
    return flag_first_seen_stream(
        rows, "deviceId", ("anchor_id", "entered"), ttl_hours, evict_delay
    )


def popular_entries_stream(
    visits: DataFrame,
    min_stay: str | int = "60 seconds",
    revisit_gap: str | int = "30 minutes",
    delay: str | int = "5 seconds",
) -> DataFrame:
    """Streaming :func:`popularity.popular_entries`, on event time."""
    id_type = visits.schema["id"].dataType.simpleString()
    rows = (
        visits.select("anchor_id", "deviceId", "timestamp", "id", "entered")
        .withColumn("_ts", event_time("timestamp"))
        .withWatermark("_ts", f"{duration_ms(delay)} milliseconds")
    )
    return _by_share(rows, ("anchor_id", "deviceId")).transformWithState(
        Popularity(duration_ms(min_stay), duration_ms(revisit_gap)),
        f"anchor_id string, deviceId string, timestamp bigint, id {id_type}",
        "Append",
        "EventTime",
    )


def top_products_stream(counts: DataFrame, n: int = 3) -> DataFrame:
    """The top products of every window of a streaming :func:`products.sliding_count`.

    Two keyed steps in a row: Spark counts windows and hands on those that close, and a
    list of ``n`` products per category, event and window waits for the window's timer.
    """
    return counts.groupBy("categoryId", "eventId", "windowStart", "windowEnd").transformWithState(
        TopList(n),
        "eventId string, categoryId string, productId string, count bigint,"
        " windowStart bigint, windowEnd bigint, rank int",
        "Append",
        "EventTime",
    )


def running_sum_stream(df: DataFrame) -> DataFrame:
    """Streaming :func:`totals.running_sum` of ``quantity`` by ``category``."""
    rows = df.select("category", "quantity", "timestamp", "id")
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.groupBy("category").transformWithState(
        RunningSum(),
        f"category string, timestamp bigint, id {id_type}, total bigint",
        "Append",
        "None",
    )
