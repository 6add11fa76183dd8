"""Row layouts of the platform's records."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


def _strings(names: str) -> list[tuple[str, T.DataType]]:
    return [(name, T.StringType()) for name in names.split()]


EVENT = _fields(
    *_strings(
        "id deviceId guid account appId appVersion carrier deviceType eventId ip"
    ),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    *_strings("netType osName osVersion releaseChannel resolution sessionId"),
    ("timestamp", T.LongType()),
    *_strings("newSessionId country province city region date hour"),
    ("properties", T.MapType(T.StringType(), T.StringType())),
    ("lastUpdate", T.LongType()),
    ("isNew", T.IntegerType()),
    ("isN", T.IntegerType()),
    ("perCnt", T.IntegerType()),
)

# Counters of an event that are zero when the record does not carry them.
EVENT_ZERO_DEFAULTS = ("isNew", "isN", "perCnt")

ORDER_MAIN = _fields(
    ("oid", T.IntegerType()),
    ("create_time", T.TimestampType()),
    ("total_money", T.DoubleType()),
    ("status", T.IntegerType()),
    ("update_time", T.TimestampType()),
    ("uid", T.IntegerType()),
    ("province", T.StringType()),
)

ORDER_DETAIL = _fields(
    ("id", T.IntegerType()),
    ("order_id", T.IntegerType()),
    ("category_id", T.IntegerType()),
    ("sku", T.IntegerType()),
    ("money", T.DoubleType()),
    ("amount", T.IntegerType()),
    ("create_time", T.TimestampType()),
    ("update_time", T.TimestampType()),
)

GIFT = _fields(
    ("id", T.IntegerType()),
    ("name", T.StringType()),
    ("points", T.DoubleType()),
    ("deleted", T.IntegerType()),
    ("updateTime", T.TimestampType()),
)

ACTIVITY_LINE = _fields(*_strings("uid activity event"))

GROUP_MAIN_LINE = _fields(
    ("ts", T.LongType()), *_strings("group_id status category")
)
GROUP_DETAIL_LINE = _fields(
    ("ts", T.LongType()), *_strings("user_id group_id order_id")
)
GROUP_ORDER_LINE = _fields(
    ("ts", T.LongType()), *_strings("order_id status"), ("amount", T.DoubleType())
)

CATEGORY_LINE = _fields(("category", T.StringType()), ("quantity", T.LongType()))

TEST_LINE = _fields(("id", T.IntegerType()), *_strings("name add"))

# Columns of the detail tables, in insert order (fixed by the tables' readers).
USER_EVENT_COLUMNS = (
    "id", "deviceId", "eventId", "isNew", "osName", "province", "releaseChannel",
    "deviceType", "timestamp", "date", "hour", "processTime",
)
ANCHOR_DETAIL_COLUMNS = (
    "id", "anchor_id", "deviceId", "eventId", "os", "province", "channel",
    "deviceType", "eventTime", "date", "hour", "processTime",
)
