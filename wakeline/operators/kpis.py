"""Fleet figures, each from one aggregation over the enriched snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS, Settings
from wakeline.functions import vessel


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def fleet_kpis(fleet: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Control-room figures: every vessel is in exactly one category."""
    category, speed = F.col("status_category"), F.col("speed")
    fresh = F.count_if(F.col("age_sec") <= settings.stale_warn_sec)
    return fleet.agg(
        F.count("*").alias("vessels"),
        F.count_if(category == "moving").alias("moving"),
        F.count_if(category == "port").alias("in_port"),
        F.count_if(category == "stopped").alias("stopped"),
        F.coalesce(F.avg(speed), F.lit(0.0)).alias("avg_speed"),
        F.max(speed).alias("max_speed"),
        fresh.alias("fresh"),
        _percent(fresh, F.count("*")).alias("fresh_pct"),
    )


def catalog_kpis(fleet: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The documented figures, which differ: moving ignores the port, ``in_port`` is
    null when no vessel is inside, and nothing is defaulted."""
    return fleet.agg(
        F.count_distinct(settings.vessel_key).alias("total_vessels"),
        F.sum(F.when(F.col("in_port"), 1)).alias("in_port"),
        F.count_if(F.col("speed") > settings.moving_kn).alias("moving"),
        F.avg("speed").alias("avg_speed"),
        F.try_divide(
            F.count_if(F.col("age_sec") <= settings.stale_warn_sec) * 100, F.count("*")
        ).alias("data_quality"),
    )


def status_counts(fleet: DataFrame) -> DataFrame:
    """Vessels per category with its display label, largest first."""
    return (
        fleet.filter(F.col("status_category").isNotNull())
        .groupBy("status_category")
        .agg(F.count("*").alias("vessels"))
        .withColumn("label", vessel.status_label(F.col("status_category")))
        .orderBy(F.desc("vessels"), "status_category")
    )


def speed_histogram(fleet: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Vessels per speed bin: equal bins between slowest and fastest, the fastest in
    the last one; empty bins are left out."""
    n = settings.histogram_bins
    # one row per distinct speed; its ends are a single row, read where they are needed
    speeds = fleet.filter(F.col("speed").isNotNull()).groupBy("speed").agg(F.count("*").alias("vessels"))
    ends = speeds.agg(F.struct(F.min("speed").alias("lo"), F.max("speed").alias("hi"))).scalar()
    lo, width, number = ends["lo"], (ends["hi"] - ends["lo"]) / n, F.col("bin")
    step = F.floor(F.try_divide(F.col("speed") - lo, width))
    index = F.when(width > 0, F.least(step + 1, F.lit(n))).otherwise(1)
    return (
        speeds.groupBy(index.cast("int").alias("bin"))
        .agg(F.sum("vessels").alias("vessels"))
        .select("bin", (lo + (number - 1) * width).alias("bin_from"), (lo + number * width).alias("bin_to"), "vessels")
        .orderBy("bin")
    )


def speed_vs_distance(fleet: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return fleet.select(settings.vessel_key, "distance_to_port_km", "speed")


def freshness_bands(fleet: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Vessels per freshness band; bands without vessels are left out."""
    band = vessel.freshness_band(F.col("age_sec"), settings)
    return fleet.groupBy(band.alias("band")).agg(F.count("*").alias("vessels"))
