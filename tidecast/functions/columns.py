"""Column expressions shared by the operators. All of them stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(ms: str | Column) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(_col(ms))


def _wall_clock(instant: Column, tz: str | None) -> Column:
    if tz is None:
        return instant
    # An instant as the zone's wall clock, whatever the session zone is.
    return F.convert_timezone(None, F.lit(tz), instant.cast("timestamp_ntz"))


def date_text(ms: str | Column, tz: str | None = None) -> Column:
    """Epoch milliseconds to ``yyyyMMdd`` (session zone unless ``tz`` is given)."""
    return F.date_format(_wall_clock(event_time(ms), tz), "yyyyMMdd")


def hour_text(ms: str | Column, tz: str | None = None) -> Column:
    """Epoch milliseconds to ``HH`` (session zone unless ``tz`` is given)."""
    return F.date_format(_wall_clock(event_time(ms), tz), "HH")


def seconds_date_hour(seconds: str | Column) -> Column:
    """Epoch seconds to ``yyyyMMdd-HH``."""
    return F.date_format(F.timestamp_seconds(_col(seconds)), "yyyyMMdd-HH")


def join_text(sep: str, *cols: str | Column) -> Column:
    """Concatenate with a separator; a null prints as ``null`` instead of vanishing."""
    return F.concat_ws(
        sep, *[F.coalesce(_col(c).cast("string"), F.lit("null")) for c in cols]
    )


def utf8(c: str | Column) -> Column:
    """UTF-8 bytes to text."""
    return F.decode(_col(c), "UTF-8")


def prop(key: str, column: str = "properties") -> Column:
    """A value of the properties map; null when the key is missing."""
    return F.col(column)[key]


def int_prop(key: str, column: str = "properties") -> Column:
    """A whole-number property; null when it is missing or not a number."""
    return prop(key, column).try_cast("int")


def floor_ms(ms: str | Column, width_ms: int) -> Column:
    """Start of the aligned interval of ``width_ms`` that holds ``ms``."""
    return _col(ms) - F.pmod(_col(ms), F.lit(width_ms))


def duration_ms(text: str | int) -> int:
    """``'30 minutes'`` to milliseconds; a number is taken as milliseconds."""
    if isinstance(text, int):
        return text
    amount, unit = text.split()
    scale = {
        "millisecond": 1, "second": 1000, "minute": 60_000,
        "hour": 3_600_000, "day": 86_400_000,
    }
    return int(amount) * scale[unit.rstrip("s")]
