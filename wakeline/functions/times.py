"""Time expressions. All assume the session time zone is UTC."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING_AGE_SEC = 1e9  # fixed value: age given to rows without a usable time


def parse_utc(text: Column) -> Column:
    """Lenient parse: unreadable text becomes null instead of failing the job."""
    return F.try_to_timestamp(text)


def moment(value: Column | datetime | str | None) -> Column:
    """The "now" of a report: given, or the query's own start time."""
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def age_seconds(ts: Column, as_of: Column) -> Column:
    """Seconds from ``ts`` to ``as_of``; negative for future times."""
    return F.coalesce((F.unix_micros(as_of) - F.unix_micros(ts)) / F.lit(1e6), F.lit(MISSING_AGE_SEC))


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def bucket_start(ts: Column, minutes: int) -> Column:
    """Start of the epoch-aligned bucket holding ``ts``."""
    return F.window(ts, f"{minutes} minutes").start


def hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))
