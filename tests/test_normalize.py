"""Raw messages, one by one."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wakeline.operators import clean, normalize, quality

T0 = datetime(2024, 1, 1)


def message(kind="PositionReport", name="A", drop=(), **fields):
    body = {"UserID": 224000001, "Latitude": 28.1, "Longitude": -15.4} | fields
    body = {k: v for k, v in body.items() if k not in drop}
    meta = {} if name is None else {"ShipName": name}
    return json.dumps({"MessageType": kind, "MetaData": meta, "Message": {kind: body}})


def run(spark, *values):
    records = spark.createDataFrame([(v,) for v in values], "value STRING")
    return normalize.normalize_ais(records, F.lit(T0)).collect()


B = "StandardClassBPositionReport"


@pytest.mark.parametrize("code, text", [(0, "Under way"), (8, "Under way"), (5, "Moored/Anchored"), (None, "Moored/Anchored")])
def test_navigational_status(spark, code, text):
    fields = {} if code is None else {"NavigationalStatus": code}
    assert run(spark, message(**fields))[0]["status"] == text


@pytest.mark.parametrize(
    "kind, fields, heading",
    [
        ("PositionReport", {"TrueHeading": 511}, 511.0),
        ("PositionReport", {}, 0.0),
        (B, {"TrueHeading": 511, "Cog": 87.5}, 87.5),
        (B, {"Cog": 87.5}, 87.5),
        (B, {"TrueHeading": 511}, 0.0),
        (B, {"TrueHeading": 12, "Cog": 87.5}, 12.0),
    ],
)
def test_heading(spark, kind, fields, heading):
    assert run(spark, message(kind, **fields))[0]["heading"] == heading


def test_defaults_and_names(spark):
    rows = run(spark, message(name=None), message(name="  A  "), message(B, name="\tB\r\n", Sog=3.5))
    assert [r["ship_name"] for r in rows] == ["Unknown-224000001", "A", "B"]
    assert [r["speed"] for r in rows] == [0.0, 0.0, 3.5]
    assert rows[2]["status"] == "Class B Active"
    assert rows[0]["mmsi"] == 224000001 and rows[0]["timestamp"] == T0


def test_mmsi_beyond_int_becomes_null(spark):
    assert run(spark, message(UserID=99999999999))[0]["mmsi"] is None


@pytest.mark.parametrize(
    "value, outcome",
    [
        (message(Latitude=91), "position_unavailable"),
        (message(Latitude=90.5), "position_unavailable"),
        (message(Longitude=181), "position_unavailable"),
        (message(Latitude=None), "missing_field"),
        (message(drop=("Longitude",)), "missing_field"),
        (message(drop=("UserID",)), "missing_field"),
        (message("ShipStaticData"), "other_kind"),
        ("{}", "other_kind"),
        ("not json", "malformed"),
        (None, "malformed"),
    ],
)
def test_dropped_with_reason(spark, value, outcome):
    assert run(spark, value) == []
    records = spark.createDataFrame([(value,)], "value STRING")
    assert normalize.ingest_outcomes(records).collect()[0].asDict() == {"outcome": outcome, "messages": 1}


def test_no_lower_bound_but_contract_flags_it(spark):
    records = spark.createDataFrame([(message(Latitude=-95),)], "value STRING")
    kept = normalize.normalize_ais(records, F.lit(T0))
    assert kept.count() == 1
    assert quality.quarantine(kept).first()["violations"] == ["lat_range"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("garbage", None),
        ("[]", None),
        ('{"mmsi":"x","lat":1.5,"lon":2.5}', {"mmsi": None, "lat": 1.5}),
        ('{"mmsi":1.5,"lat":1.5,"lon":2.5}', {"mmsi": None, "lat": 1.5}),
        ('{"mmsi":99999999999,"lat":1.5,"lon":2.5}', {"mmsi": None, "lat": 1.5}),
        ('{"mmsi":7,"lat":"3.0","lon":2.5}', None),
        ('{"mmsi":7,"lat":1.5,"lon":2.5,"extra":{"a":1}}', {"mmsi": 7, "lat": 1.5}),
        ('{"mmsi":7,"lat":0,"lon":2.5}', None),
        ('{"mmsi":7,"lat":1.5}', None),
        (None, None),
    ],
)
def test_event_parsing_and_coordinate_filter(spark, text, expected):
    records = spark.createDataFrame([(text,)], "value STRING")
    rows = clean.drop_sentinel_positions(clean.parse_events(records)).collect()
    if expected is None:
        assert rows == []
    else:
        assert {k: rows[0][k] for k in expected} == expected


def test_event_times(spark):
    texts = ["2025-01-04T10:30:00Z", "2025-01-04T10:30:00.5+00:00", "2025-01-04T12:30:00+02:00", "soon", None]
    values = [json.dumps({"lat": 1, "lon": 1, "timestamp": t}) for t in texts]
    records = spark.createDataFrame([(v,) for v in values], "value STRING")
    got = [r["timestamp"] for r in clean.parse_events(records).collect()]
    half = datetime(2025, 1, 4, 10, 30)
    assert got == [half, half.replace(microsecond=500000), half, None, None]


def test_nan_is_missing_after_cleaning(spark):
    rows = spark.createDataFrame([(1.0, 2.0, float("nan"), 3.0)], "lat DOUBLE, lon DOUBLE, speed DOUBLE, heading DOUBLE")
    assert clean.to_silver(rows).first()["speed"] is None


@pytest.mark.parametrize(
    "change, broken",
    [
        ({}, []),
        ({"mmsi": 99999999}, ["mmsi_digits", "mmsi_range"]),
        ({"mmsi": 100000000}, []),
        ({"mmsi": 999999999}, []),
        ({"mmsi": 1000000000}, ["mmsi_digits", "mmsi_range"]),
        ({"mmsi": -12345678}, ["mmsi_range"]),
        ({"lat": 90.0, "lon": 180.0}, []),
        ({"lat": -90.0, "lon": -180.0}, []),
        ({"lat": 90.01}, ["lat_range"]),
        ({"lon": -180.01}, ["lon_range"]),
        ({"speed": -0.1}, ["speed_negative"]),
        ({"speed": 0.0}, []),
        ({"speed": 102.2}, []),
        ({"speed": 102.3}, ["speed_limit"]),
        ({"heading": -1.0}, ["heading_range"]),
        ({"heading": 360.0}, []),
        ({"heading": 360.1}, ["heading_range"]),
        ({"heading": 511.0}, ["heading_range"]),
        ({"ship_name": None, "lat": None}, ["ship_name_missing", "lat_missing"]),
        ({"lat": float("nan")}, ["lat_range"]),
    ],
)
def test_contract(spark, change, broken):
    good = dict(mmsi=224000001, ship_name="A", lat=28.1, lon=-15.4, speed=1.0, heading=10.0, status="x", timestamp=T0)
    row = spark.createDataFrame(
        [tuple((good | change).values())],
        "mmsi INT, ship_name STRING, lat DOUBLE, lon DOUBLE, speed DOUBLE, heading DOUBLE, status STRING, timestamp TIMESTAMP",
    )
    assert quality.with_violations(row).first()["violations"] == broken
    assert quality.valid_positions(row).count() == (not broken)
    assert quality.quarantine(row).count() == bool(broken)
    assert sorted(r["rule"] for r in quality.violation_counts(row).collect()) == sorted(broken)
