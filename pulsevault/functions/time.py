"""Sample times and calendar buckets. Hours are shifted by a fixed number, never by the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Anchor of sample offsets: 2024-01-01 00:00 at UTC+9, in ms.
T0 = 1704034800000
DAY_MS = 86_400_000


def offset_seconds(offset_ms: Column) -> Column:
    return offset_ms / F.lit(1000.0)


def absolute_ms(t0: Column, offset_ms: Column) -> Column:
    """Epoch milliseconds of a sample."""
    return (t0 + F.floor(offset_ms)).cast("long")


def local_date(ms: Column, tz_hours: float = 0) -> Column:
    """The date at `tz_hours` from UTC; plain arithmetic, so no session setting matters."""
    return F.date_from_unix_date(F.floor((ms + F.lit(int(tz_hours * 3_600_000))) / F.lit(DAY_MS)).cast("int"))


def bucket_key(ms: Column, granularity: str = "day", tz_hours: float = 0) -> Column:
    """YYYY_MM_DD, ISO YYYY_Www or YYYY_MM."""
    d = local_date(ms, tz_hours)
    if granularity == "day":
        return F.date_format(d, "yyyy_MM_dd")
    if granularity == "month":
        return F.date_format(d, "yyyy_MM")
    if granularity == "week":
        return F.format_string("%04d_W%02d", F.extract(F.lit("YEAROFWEEK"), d).cast("int"), F.weekofyear(d))
    raise ValueError(f"granularity {granularity!r}")
