"""Reports composed from the operators: what a control room asks of the lake table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.config import DEFAULTS, Settings
from wakeline.functions import vessel
from wakeline.operators import alerts as al
from wakeline.operators import kpis, rankings
from wakeline.operators.fleet import enrich, filter_fleet
from wakeline.operators.latest import latest_per_vessel
from wakeline.operators.timeline import near, traffic_timeline

SNAPSHOT_COLUMNS = schemas.SNAPSHOT_COLUMNS


def fleet_snapshot(
    lake: DataFrame,
    settings: Settings = DEFAULTS,
    as_of: Column | datetime | str | None = None,
    ties: Sequence[str] = (),
    columns: Sequence[str] = SNAPSHOT_COLUMNS,
) -> DataFrame:
    """Latest position per vessel, enriched. Name fewer ``columns`` to read less."""
    key = settings.vessel_key
    latest = latest_per_vessel(lake, key, ties=ties, columns=(key, *columns, *ties))
    return enrich(latest.select(key, *columns), settings, as_of)


def control_room(
    lake: DataFrame,
    settings: Settings = DEFAULTS,
    as_of: Column | datetime | str | None = None,
    with_alerts: bool = True,
    newest_day: date | None = None,
    **filters,
) -> dict[str, DataFrame]:
    """Every report by name. The snapshot feeds most of them, so it is computed once
    and kept (one row per vessel); ``reports["fleet"].unpersist()`` releases it.

    Fleet figures and freshness cover all vessels; tables, charts and alerts the
    vessels passing ``filters`` (as for ``filter_fleet``). Without ``with_alerts`` the
    alert reports are left out and every marker is a normal one. ``newest_day``, where it is
    known (``readers.newest_day``) and ``as_of`` is not given, keeps the timeline to the
    partitions it needs.
    """
    fleet = fleet_snapshot(lake, settings, as_of).persist()
    shown = filter_fleet(fleet, settings, **filters)
    alerts = al.find_alerts(shown, settings)
    recent = near(lake, newest_day, settings.history_hours) if newest_day and as_of is None else lake
    alert_reports = {"alerts": al.ordered_alerts(alerts), "alert_kpis": al.alert_kpis(alerts)}
    return {
        "fleet": fleet,
        "fleet_kpis": kpis.fleet_kpis(fleet, settings),
        "freshness": kpis.freshness_bands(fleet, settings),
        "stalest": rankings.stalest(fleet, settings),
        "operational_table": rankings.operational_table(shown, settings),
        "top_speed": rankings.top_speed(shown, settings),
        "status_counts": kpis.status_counts(shown),
        "speed_histogram": kpis.speed_histogram(shown, settings),
        "speed_vs_distance": kpis.speed_vs_distance(shown, settings),
        "map_layers": map_layers(shown, settings, with_alerts),
        **(alert_reports if with_alerts else {}),
        "timeline": traffic_timeline(recent, settings, as_of),
    }


def map_layers(
    fleet: DataFrame, settings: Settings = DEFAULTS, with_alerts: bool = True
) -> DataFrame:
    """Marker per vessel: layer ``alert`` (fixed colour and size) or ``normal``.

    An alert is decided by its own row alone, so no join is needed here.
    """
    alerting = al.alert_type(settings).isNotNull() if with_alerts else F.lit(False)
    return fleet.select(
        settings.vessel_key,
        "lat",
        "lon",
        F.when(alerting, "alert").otherwise("normal").alias("layer"),
        F.when(alerting, vessel.rgba(vessel.ALERT_COLOUR)).otherwise(F.col("color")).alias("color"),
        F.when(alerting, float(vessel.ALERT_RADIUS)).otherwise(F.col("size")).alias("radius"),
    )
