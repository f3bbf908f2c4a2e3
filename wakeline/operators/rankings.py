"""Bounded, ordered reports. Each is a top-k that never sorts the whole input;
the vessel key closes every order so that ties are stable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.config import DEFAULTS, Settings


def operational_table(fleet: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """By category, fastest first, at most ``max_rows``."""
    return (
        fleet.select(settings.vessel_key, *schemas.OPERATIONAL_COLUMNS)
        .orderBy(
            F.asc_nulls_last("status_category"), F.desc_nulls_last("speed"), settings.vessel_key
        )
        .limit(settings.max_rows)
    )


def top_speed(fleet: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return (
        fleet.select(settings.vessel_key, *schemas.TOP_SPEED_COLUMNS)
        .orderBy(F.desc_nulls_last("speed"), settings.vessel_key)
        .limit(settings.top_speed_rows)
    )


def stalest(fleet: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The vessels heard from longest ago."""
    return (
        fleet.select(settings.vessel_key, *schemas.STALEST_COLUMNS)
        .orderBy(F.desc_nulls_last("age_sec"), settings.vessel_key)
        .limit(settings.worst_rows)
    )
