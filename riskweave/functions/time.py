"""Whole seconds and microseconds of wall-clock time, whatever the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_seconds(ts: Column | str) -> Column:
    """Seconds since 1970-01-01 00:00 on the clock the timestamp shows."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    day = F.datediff(ts, F.to_date(F.lit("1970-01-01"))).cast("long")
    return day * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)


def clock_micros(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    fraction = F.date_part(F.lit("SECOND"), ts) - F.second(ts)
    return clock_seconds(ts) * 1_000_000 + (fraction * 1_000_000).cast("long")
