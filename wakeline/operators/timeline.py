"""Traffic over time."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS, Settings
from wakeline.functions.times import bucket_start, hours


def newest_time(positions: DataFrame) -> Column:
    """The table's own newest time, as a scalar subquery.

    On a table partitioned by ``date`` only the newest partition's times are read. To find
    that date every file is opened, though no column of it is read; a caller
    that knows it from the folders narrows the table first (``near``).
    """
    if "date" in positions.columns:
        newest_date = positions.agg(F.max("date")).scalar()
        positions = positions.filter(F.col("date") == newest_date)
    return positions.agg(F.max("timestamp")).scalar()


def near(positions: DataFrame, newest_day: date, window_hours: int) -> DataFrame:
    """Only the partitions that a window of that length up to the end of ``newest_day`` can
    touch; a literal bound, so the others are not even planned."""
    first = newest_day - timedelta(days=-(-window_hours // 24))
    return positions.filter(F.col("date") >= F.lit(first))


def trailing(positions: DataFrame, window_hours: int, as_of: Column | datetime | None = None) -> DataFrame:
    """Rows no older than ``window_hours`` before ``as_of`` (default: the newest time).

    The bound is a literal or a scalar subquery, never a join; on a table
    partitioned by ``date`` it also prunes partitions.
    """
    if as_of is None:
        end = newest_time(positions)
    else:
        end = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    start = end - hours(window_hours)
    recent = positions.filter(F.col("timestamp") >= start)
    return recent.filter(F.col("date") >= F.to_date(start)) if "date" in positions.columns else recent


def bucket_counts(moving_kn: float) -> list[Column]:
    """Row counts per bucket. A missing speed counts as neither moving nor stopped."""
    inside = F.coalesce(F.col("in_port"), F.lit(False))
    outside, speed = ~F.col("in_port"), F.col("speed")
    return [
        F.count_if(inside).alias("rows_in_port"),
        F.count_if(outside & (speed > moving_kn)).alias("rows_moving"),
        F.count_if(outside & (speed <= moving_kn)).alias("rows_stopped"),
    ]


def bucketed(positions: DataFrame, minutes: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Distinct vessels and row counts per time bucket, unordered.

    Rows are pre-aggregated per (bucket, vessel) in each task before the first
    shuffle and per bucket before the second, so neither a busy bucket nor a
    busy vessel concentrates rows.
    """
    return positions.groupBy(bucket_start(F.col("timestamp"), minutes).alias("ts_bin")).agg(
        F.count_distinct(settings.vessel_key).alias("vessels_total"),
        *bucket_counts(settings.moving_kn),
    )


def traffic_timeline(
    positions: DataFrame, settings: Settings = DEFAULTS, as_of: Column | datetime | None = None
) -> DataFrame:
    recent = trailing(positions, settings.history_hours, as_of)
    return bucketed(recent, settings.bucket_minutes, settings).orderBy("ts_bin")
