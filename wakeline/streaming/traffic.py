"""Windowed traffic counts on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS, Settings
from wakeline.operators.timeline import bucket_counts


def stream_traffic(
    silver: DataFrame, settings: Settings = DEFAULTS, lateness: str = "10 minutes"
) -> DataFrame:
    """The batch timeline's columns, one row per closed bucket (append mode).

    A streaming plan cannot count distinct values exactly in one step, so rows
    are first reduced to one per (bucket, vessel) and these counted per bucket.
    """
    per_vessel = (
        silver.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", f"{settings.bucket_minutes} minutes"), settings.vessel_key)
        .agg(*bucket_counts(settings.moving_kn))
    )
    named = F.count_if(F.col(settings.vessel_key).isNotNull()).alias("vessels_total")
    rows = ("rows_in_port", "rows_moving", "rows_stopped")
    return (
        per_vessel.groupBy("window")
        .agg(named, *[F.sum(c).alias(c) for c in rows])
        .select(F.col("window.start").alias("ts_bin"), "vessels_total", *rows)
    )
