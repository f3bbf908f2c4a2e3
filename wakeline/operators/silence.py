"""Vessels that stopped reporting for a while."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS
from wakeline.operators.ordered import SLICE_HOURS, with_neighbour


def silences(
    positions: DataFrame, limit_sec: float, until: Column, key: str = DEFAULTS.vessel_key, slice_hours: int = SLICE_HOURS
) -> DataFrame:
    """``key, silent_since, resumed_at``: every time a vessel was not heard from for longer than
    ``limit_sec``, as known at ``until``; ``resumed_at`` is null if it has not been heard from since."""
    limit = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(limit_sec))
    times = positions.select(key, "timestamp").filter(F.col("timestamp").isNotNull()).distinct()

    def long(following: Column) -> Column:
        return F.coalesce(following["timestamp"], until) > F.col("timestamp") + limit

    found = with_neighbour(times, key, "timestamp", ["timestamp"], "_next", forward=True, keep=long, slice_hours=slice_hours)
    return found.select(key, F.col("timestamp").alias("silent_since"), F.col("_next.timestamp").alias("resumed_at"))
