"""Enriched fleet snapshot and the filters a user can apply to it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS, Settings
from wakeline.functions import times, vessel
from wakeline.functions.geo import haversine_km

CATEGORIES = ("moving", "stopped", "port")


def enrich(
    snapshot: DataFrame, settings: Settings = DEFAULTS, as_of: Column | datetime | str | None = None
) -> DataFrame:
    """Add distance to the harbour, category, freshness and marker style.

    Only projections, so unused ones are pruned away. Needs ``lat, lon, speed,
    in_port, timestamp``.
    """
    centre_lat, centre_lon = (F.lit(v) for v in settings.harbour_centre)
    category, age = F.col("status_category"), F.col("age_sec")
    return snapshot.withColumns(
        {
            "time_display": times.clock_text(F.col("timestamp")),
            "distance_to_port_km": haversine_km(F.col("lat"), F.col("lon"), centre_lat, centre_lon),
            "status_category": vessel.status_category(F.col("in_port"), F.col("speed"), settings),
            "age_sec": times.age_seconds(F.col("timestamp"), times.moment(as_of)),
        }
    ).withColumns(
        {
            "quality_score": vessel.quality_score(age, settings),
            "color": vessel.marker_colour(category),
            "size": vessel.marker_size(F.col("speed")),
        }
    )


def name_matches(name: Column, pattern: str, literal: bool = False) -> Column:
    """Case-insensitive search; ``pattern`` is a regular expression unless ``literal``."""
    if literal:
        hit = F.contains(F.lower(name), F.lit(pattern.lower()))
    else:
        hit = F.rlike(name, F.lit("(?i)" + pattern))
    return F.coalesce(hit, F.lit(False))


def filter_fleet(
    fleet: DataFrame,
    settings: Settings = DEFAULTS,
    statuses: Sequence[str] = CATEGORIES,
    search: str = "",
    literal: bool = False,
    zone: str | None = None,
    min_quality: int | None = None,
) -> DataFrame:
    """Category, speed and distance limits, name search, zone ("inside"/"outside")
    and least quality score. A missing speed or distance fails its limit."""
    kept = fleet.filter(
        F.col("status_category").isin(list(statuses))
        & (F.col("speed") >= settings.min_speed_kn)
        & (F.col("distance_to_port_km") <= settings.max_distance_km)
    )
    if search.strip():
        kept = kept.filter(name_matches(F.col(settings.vessel_key), search.strip(), literal))
    if zone is not None:
        kept = filter_zone(kept, zone)
    if min_quality is not None:
        kept = kept.filter(F.col("quality_score") >= min_quality)
    return kept


def filter_zone(fleet: DataFrame, zone: str) -> DataFrame:
    if zone not in ("inside", "outside"):
        raise ValueError("zone must be 'inside' or 'outside'")
    inside = F.coalesce(F.col("in_port"), F.lit(False))
    return fleet.filter(inside if zone == "inside" else ~inside)
