"""Enrichment, filters, alerts and figures on hand-made rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS, Settings
from wakeline.functions.vessel import status_label
from wakeline.operators import alerts, fleet, kpis, rankings
from wakeline.plans import reports

NOW = datetime(2024, 1, 1, 12)
SCHEMA = "ship_name STRING, lat DOUBLE, lon DOUBLE, speed DOUBLE, heading DOUBLE, in_port BOOLEAN, timestamp TIMESTAMP"


def enriched(spark, *rows, settings=DEFAULTS):
    made = [
        (r.get("ship", "A"), r.get("lat", 28.2), r.get("lon", -15.3), r.get("speed", 1.0), 0.0,
         r.get("in_port", False), None if r.get("age", 0) is None else NOW - timedelta(seconds=r.get("age", 0)))
        for r in rows
    ]
    return fleet.enrich(spark.createDataFrame(made, SCHEMA), settings, NOW)


@pytest.mark.parametrize(
    "speed, in_port, category",
    [(0.5, False, "stopped"), (0.51, False, "moving"), (None, False, "stopped"), (12.0, True, "port"), (2.0, None, "moving")],
)
def test_category(spark, speed, in_port, category):
    assert enriched(spark, dict(speed=speed, in_port=in_port)).first()["status_category"] == category


@pytest.mark.parametrize("age, score", [(60, 100), (61, 60), (180, 60), (181, 20), (None, 20), (-5, 100)])
def test_quality_score(spark, age, score):
    row = enriched(spark, dict(age=age)).first()
    assert row["quality_score"] == score
    assert row["age_sec"] == (1e9 if age is None else age)


@pytest.mark.parametrize("speed, size", [(0.0, 280), (3.0, 660), (10.0, 1200), (None, 280), (float("nan"), 280)])
def test_marker_size(spark, speed, size):
    assert enriched(spark, dict(speed=speed)).first()["size"] == pytest.approx(size)


def test_colours_and_labels(spark):
    rows = enriched(spark, dict(speed=0.0), dict(speed=5.0), dict(in_port=True)).collect()
    assert [r["color"] for r in rows] == [[239, 68, 68, 190], [16, 185, 129, 190], [59, 130, 246, 200]]
    labels = spark.createDataFrame([("port",), ("elsewhere",)], "k STRING").select(status_label(F.col("k"))).collect()
    assert [r[0] for r in labels] == ["En puerto", "elsewhere"]


ALERT_FLEET = "ship_name STRING, lat DOUBLE, lon DOUBLE, speed DOUBLE, in_port BOOLEAN, distance_to_port_km DOUBLE, timestamp TIMESTAMP"


@pytest.mark.parametrize(
    "speed, distance, in_port, priority",
    [
        (10.0, 5.0, True, "high"),
        (10.0, 5.01, False, None),
        (9.99, 2.0, True, None),
        (0.19, 3.0, False, "medium"),
        (0.2, 3.0, False, "low"),
        (None, 2.0, False, "low"),
        (5.0, 2.0, None, "low"),
        (12.0, None, False, None),
    ],
)
def test_alert_rules(spark, speed, distance, in_port, priority):
    # The distance is set by hand; the position only has to lie in the alert area.
    rows = spark.createDataFrame([("A", 28.14, -15.42, speed, in_port, distance, NOW)], ALERT_FLEET)
    got = alerts.find_alerts(rows).collect()
    assert [r["priority"] for r in got] == ([priority] if priority else [])
    assert alerts.find_alerts(rows, enabled=False).count() == 0
    if priority == "high":
        assert got[0]["message"] == "A navega a 10.0 kn a 5.0 km del puerto."
        assert got[0]["time"] == "12:00:00"
        assert alerts.with_titles(alerts.find_alerts(rows)).first()["type"].endswith("cerca del puerto")


def test_alert_area_drops_nothing(spark, sf):
    """The area filter before the rules must not change the answer."""
    from wakeline.plans.queries import WIDE
    from wakeline.sources import fixture

    rows = fleet.enrich(fixture.silver(spark, sf), WIDE, F.col("timestamp"))
    direct = rows.filter(alerts.alert_type(WIDE).isNotNull()).count()
    assert direct == alerts.find_alerts(rows, WIDE).count() > 0


def test_unseen_alerts(spark):
    rows = spark.createDataFrame(
        [("A", 28.14, -15.42, 12.0, False, 1.0, NOW), ("A", 28.14, -15.42, 12.5, False, 1.0, NOW),
         ("B", 28.14, -15.42, 12.0, False, 1.0, NOW)], ALERT_FLEET)
    found = alerts.find_alerts(rows)
    assert {r["ship"]: r["raised"] for r in alerts.distinct_alerts(found).collect()} == {"A": 2, "B": 1}
    seen = spark.createDataFrame([("high|A|speeding_near_port|12:00:00",)], "alert_key STRING")
    assert [r["ship"] for r in alerts.unseen_alerts(found, seen).collect()] == ["B"]


def test_alert_order_and_map_layers(spark):
    rows = enriched(
        spark,
        dict(ship="far", lat=29.0),
        dict(ship="near", lat=28.19, lon=-15.42, speed=3.0),
        dict(ship="fast", lat=28.15, lon=-15.42, speed=20.0, in_port=True),
        settings=DEFAULTS,
    )
    wide = DEFAULTS.but(stopped_near_port_km=8.0)
    ordered = alerts.ordered_alerts(alerts.find_alerts(rows, wide)).collect()
    assert [(r["ship"], r["priority_rank"]) for r in ordered] == [("fast", 0), ("near", 2)]
    layers = {r["ship_name"]: r for r in reports.map_layers(rows, wide).collect()}
    assert layers["far"]["layer"] == "normal" and layers["fast"]["radius"] == 900.0
    assert layers["near"]["color"] == [245, 158, 11, 220]


def test_filters(spark):
    rows = enriched(
        spark, dict(ship="ALPHA", speed=5.0), dict(ship="beta", speed=None), dict(ship=None, speed=5.0),
        dict(ship="port one", in_port=True, speed=0.0), dict(ship="old", age=500, speed=5.0),
    )

    def names(**how):
        return sorted(str(r["ship_name"]) for r in fleet.filter_fleet(rows, **how).collect())

    assert names() == ["ALPHA", "None", "old", "port one"]
    assert names(search="alp") == ["ALPHA"]
    assert names(search="^.L[pq]") == ["ALPHA"]
    assert names(search=".", literal=True) == []
    assert names(search="  ") == names()
    assert names(zone="inside") == ["port one"]
    assert names(min_quality=60) == ["ALPHA", "None", "port one"]
    assert names(statuses=["port"]) == ["port one"]
    with pytest.raises(ValueError):
        fleet.filter_fleet(rows, zone="near")


def test_figures_of_an_empty_fleet(spark):
    none = enriched(spark, dict()).filter(F.lit(False))
    row = kpis.fleet_kpis(none).first()
    assert (row["vessels"], row["avg_speed"], row["fresh_pct"], row["max_speed"]) == (0, 0.0, 0.0, None)
    row = kpis.catalog_kpis(none).first()
    assert (row["total_vessels"], row["in_port"], row["data_quality"]) == (0, None, None)
    assert kpis.speed_histogram(none).count() == 0


def test_histogram_edges(spark):
    same = enriched(spark, dict(speed=4.0), dict(speed=4.0))
    assert [tuple(r) for r in kpis.speed_histogram(same).collect()] == [(1, 4.0, 4.0, 2)]
    spread = enriched(spark, *[dict(speed=float(v)) for v in range(19)], dict(speed=None))
    bins = kpis.speed_histogram(spread).collect()
    assert [r["bin"] for r in bins] == list(range(1, 19))
    assert bins[-1]["vessels"] == 2 and sum(r["vessels"] for r in bins) == 19


def test_rankings_put_missing_last(spark):
    rows = enriched(spark, dict(ship="a", speed=None), dict(ship="b", speed=3.0), dict(ship="c", speed=9.0))
    assert [r["ship_name"] for r in rankings.top_speed(rows).collect()] == ["c", "b", "a"]
    assert rankings.operational_table(rows, DEFAULTS.but(max_rows=20)).count() == 3


def test_settings_are_checked():
    with pytest.raises(ValueError):
        Settings(bucket_minutes=7)
    with pytest.raises(ValueError):
        DEFAULTS.but(speed_high_kn=50.0)
    with pytest.raises(TypeError):
        DEFAULTS.but(colour="red")
