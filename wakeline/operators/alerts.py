"""Alert rules over an enriched fleet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS, Settings
from wakeline.functions.geo import circle_box, in_rectangle
from wakeline.functions.times import clock_text
from wakeline.functions.vessel import one_decimal
from wakeline.operators.once import evaluate_once

# Priorities in order, rule codes, their display titles and messages.
PRIORITY_RANK = {"high": 0, "medium": 1, "low": 2}
OTHER_RANK = 9
SPEEDING, STOPPED, APPROACHING, STALE = (
    "speeding_near_port", "stopped_near_port", "approaching_port", "stale_position",
)
TITLES = {
    SPEEDING: "🚨 Velocidad excesiva cerca del puerto",
    STOPPED: "⚠️ Buque parado en zona de navegación",
    APPROACHING: "🧭 Aproximándose al puerto",
}
MESSAGES = {
    SPEEDING: "%s navega a %s kn a %s km del puerto.",
    STOPPED: "%s está parado a %s km del puerto (fuera de geofence).",
    APPROACHING: "%s se aproxima (distancia: %s km).",
}

ALERT_COLUMNS = ("ship", "priority", "priority_rank", "type", "message", "speed", "distance", "time")


def priority_rank(priority: Column) -> Column:
    chain = F.when(priority == "high", PRIORITY_RANK["high"])
    for name in ("medium", "low"):
        chain = chain.when(priority == name, PRIORITY_RANK[name])
    return chain.otherwise(OTHER_RANK)


def alert_type(settings: Settings = DEFAULTS) -> Column:
    """Code of the first rule a row meets, null if none. In order: too fast near the
    port (inside or not), stopped outside but close, otherwise close outside."""
    speed, distance = F.col("speed"), F.col("distance_to_port_km")
    outside = ~F.coalesce(F.col("in_port"), F.lit(False))
    close = outside & (distance <= settings.stopped_near_port_km)
    return (
        F.when((speed >= settings.speed_high_kn) & (distance <= settings.near_port_km), SPEEDING)
        .when(close & (speed < settings.stopped_kn), STOPPED)
        .when(close, APPROACHING)
    )


def _priority(code: Column) -> Column:
    return F.when(code == SPEEDING, "high").when(code == STOPPED, "medium").otherwise("low")


def _message(ship: Column, code: Column, speed: Column, distance: Column) -> Column:
    kn, km = one_decimal(speed), one_decimal(distance)
    return (
        F.when(code == SPEEDING, F.format_string(MESSAGES[SPEEDING], ship, kn, km))
        .when(code == STOPPED, F.format_string(MESSAGES[STOPPED], ship, km))
        .when(code == APPROACHING, F.format_string(MESSAGES[APPROACHING], ship, km))
    )


def find_alerts(
    fleet: DataFrame,
    settings: Settings = DEFAULTS,
    enabled: bool = True,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per vessel meeting a rule, unordered. Apply to the filtered fleet.
    ``carry`` names fleet columns to keep beside the alert's own."""
    ship, code = F.col(settings.vessel_key), F.col("type")
    speed, distance = F.col("speed"), F.col("distance_to_port_km")
    reach = max(settings.near_port_km, settings.stopped_near_port_km)
    box = circle_box(*settings.harbour_centre, reach)
    if box is not None:
        # Every rule needs a short distance; the box says so in terms a scan can use.
        fleet = fleet.filter(in_rectangle(F.col("lat"), F.col("lon"), box))
    hits = evaluate_once(fleet, alert_type(settings), "type").filter(code.isNotNull())
    if not enabled:
        hits = hits.filter(F.lit(False))
    return hits.select(
        ship.alias("ship"),
        _priority(code).alias("priority"),
        priority_rank(_priority(code)).alias("priority_rank"),
        code,
        _message(ship, code, speed, distance).alias("message"),
        speed,
        distance.alias("distance"),
        clock_text(F.col("timestamp")).alias("time"),
        *carry,
    )


def stale_alerts(fleet: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Vessels not heard from for longer than the stale limit. Kept apart from the
    three position rules."""
    return fleet.filter(F.col("age_sec") > settings.stale_bad_sec).select(
        F.col(settings.vessel_key).alias("ship"),
        F.lit("low").alias("priority"),
        F.lit(STALE).alias("type"),
        "age_sec",
        F.col("time_display").alias("time"),
    )


def ordered_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy("priority_rank", "ship")


def with_titles(alerts: DataFrame) -> DataFrame:
    """Replace rule codes by their display titles."""
    pairs = [F.lit(x) for pair in TITLES.items() for x in pair]
    return alerts.withColumn("type", F.coalesce(F.create_map(*pairs)[F.col("type")], F.col("type")))


def high_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("priority") == "high")


def alerting_vessels(fleet: DataFrame, alerts: DataFrame, key: str = DEFAULTS.vessel_key) -> DataFrame:
    """Fleet rows of vessels with an alert. Neither side is broadcast by hint:
    adaptive execution does so once it has measured the alert side. Where ``alerts``
    derive from ``fleet``, compute ``fleet`` once before."""
    return fleet.join(alerts.select(F.col("ship").alias(key)), key, "left_semi")


def quiet_vessels(fleet: DataFrame, alerts: DataFrame, key: str = DEFAULTS.vessel_key) -> DataFrame:
    """Fleet rows of vessels without an alert."""
    return fleet.join(alerts.select(F.col("ship").alias(key)), key, "left_anti")


def alert_kpis(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count("*").alias("active_alerts"),
        F.count_if(F.col("priority") == "high").alias("critical_alerts"),
    )


def alert_key() -> Column:
    return F.concat_ws("|", "priority", "ship", "type", "time")


def distinct_alerts(alerts: DataFrame) -> DataFrame:
    """High alerts, one row per notification key, with how often it was raised."""
    return (
        high_alerts(alerts)
        .groupBy("priority", "ship", "type", "time")
        .agg(F.count("*").alias("raised"))
        .withColumn("alert_key", alert_key())
    )


def unseen_alerts(alerts: DataFrame, seen_keys: DataFrame) -> DataFrame:
    """Distinct high alerts whose ``alert_key`` is not in ``seen_keys``."""
    return distinct_alerts(alerts).join(seen_keys.select("alert_key"), "alert_key", "left_anti")
