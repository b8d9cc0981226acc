"""Event-time helpers: duration parsing and epoch-microsecond conversions.

All helpers build JVM-side column expressions.  Conversions are exact and
independent of the session time zone for TIMESTAMP_NTZ columns; TIMESTAMP
columns are converted with ``unix_micros`` / ``timestamp_micros``.
"""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {
    "microsecond": 1, "microseconds": 1, "us": 1,
    "millisecond": 1_000, "milliseconds": 1_000, "ms": 1_000,
    "second": 1_000_000, "seconds": 1_000_000, "sec": 1_000_000, "s": 1_000_000,
    "minute": 60_000_000, "minutes": 60_000_000, "min": 60_000_000, "m": 60_000_000,
    "hour": 3_600_000_000, "hours": 3_600_000_000, "h": 3_600_000_000,
    "day": 86_400_000_000, "days": 86_400_000_000, "d": 86_400_000_000,
}
_TOKEN = re.compile(r"\s*(-?\d+)\s*([a-zA-Z]+)\s*")

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def duration_us(d: str | int | timedelta) -> int:
    """'1 hour', '5 minutes', '1 day 2 hours', timedelta or int microseconds -> microseconds."""
    if isinstance(d, timedelta):
        return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds
    if isinstance(d, int):
        return d
    total, pos = 0, 0
    s = d.strip()
    while pos < len(s):
        m = _TOKEN.match(s, pos)
        if not m or m.group(2).lower() not in _UNITS:
            raise ValueError(f"cannot parse duration {d!r}")
        total += int(m.group(1)) * _UNITS[m.group(2).lower()]
        pos = m.end()
    return total


def interval_str(us: int) -> str:
    """Microseconds -> a Spark interval string accepted by ``F.window``."""
    if us % 1_000_000 == 0:
        return f"{us // 1_000_000} seconds"
    return f"{us} microseconds"


_UTC_NAMES = {"UTC", "Z", "GMT", "Etc/UTC", "Etc/GMT", "+00:00", "UTC+00:00", "GMT+00:00"}


def _session_is_utc() -> bool:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark is None or spark.conf.get("spark.sql.session.timeZone") in _UTC_NAMES


def to_micros(c: Column | str, dtype: T.DataType) -> Column:
    """Epoch microseconds of a timestamp column (exact; NTZ is read as UTC wall clock).

    ``timestampdiff`` casts NTZ through the session zone, which is exact only
    when that zone is UTC (ubeat's default); otherwise the value is assembled
    from its calendar fields, which never involve a zone.
    """
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.TimestampNTZType):
        if _session_is_utc():
            return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), c)
        days = F.date_diff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
        secs_us = (F.extract(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long")
        return (days * F.lit(86_400_000_000) + F.hour(c).cast("long") * F.lit(3_600_000_000)
                + F.minute(c).cast("long") * F.lit(60_000_000) + secs_us)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return c.cast("long")
    raise TypeError(f"not a timestamp type: {dtype}")


def from_micros(us: Column, dtype: T.DataType) -> Column:
    """Inverse of :func:`to_micros`, producing the same timestamp type."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", us, F.expr(EPOCH_NTZ))
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(us)
    return us


def floor_div(a: Column, b: int) -> Column:
    """Exact floor division of a long column by a positive constant (also below zero).

    ``pmod`` keeps the remainder non-negative, so ``(a - pmod(a, b)) div b`` is the
    floor; ``div`` is Spark's integral division, no floating point involved.
    """
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def epoch_seconds_to_ts(c: Column | str, ntz: bool = True) -> Column:
    """Epoch seconds (long) -> timestamp, the reference's ``timestamp * 1000L``."""
    c = F.col(c) if isinstance(c, str) else c
    us = c.cast("long") * F.lit(1_000_000)
    return from_micros(us, T.TimestampNTZType() if ntz else T.TimestampType())
