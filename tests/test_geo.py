import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS, HARBOUR
from wakeline.functions.geo import (
    circle_box, haversine_km, in_polygon, in_polygon_column, in_rectangle,
)

L_SHAPE = [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0)]


def points(spark, rows):
    return spark.createDataFrame(rows, "lat DOUBLE, lon DOUBLE")


@pytest.mark.parametrize(
    "lat, lon, inside",
    [
        (28.14, -15.42, True),
        (28.10, -15.45, True),
        (28.18, -15.39, True),
        (28.10, -15.42, True),
        (28.0999, -15.42, False),
        (28.14, -15.3899, False),
    ],
)
def test_harbour_edges(spark, lat, lon, inside):
    row = points(spark, [(lat, lon)]).select(
        in_rectangle(F.col("lat"), F.col("lon"), HARBOUR).alias("box"),
        in_polygon(F.col("lat"), F.col("lon"), HARBOUR.vertices()).alias("polygon"),
    ).first()
    assert (row["box"], row["polygon"]) == (inside, inside)


def test_concave_polygon_in_both_forms(spark):
    rows = [(y / 2, x / 2) for y in range(-1, 8) for x in range(-1, 10)]

    def expected(lat, lon):
        return (0 <= lon <= 4 and 0 <= lat <= 1) or (0 <= lon <= 1 and 0 <= lat <= 3)

    polygon = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in L_SHAPE])
    got = points(spark, rows).select(
        "lat", "lon",
        in_polygon(F.col("lat"), F.col("lon"), L_SHAPE).alias("constant"),
        in_polygon_column(F.col("lat"), F.col("lon"), polygon).alias("column"),
    ).collect()
    for r in got:
        assert r["constant"] == r["column"] == expected(r["lat"], r["lon"]), r


def test_polygon_needs_three_vertices():
    with pytest.raises(ValueError):
        in_polygon(F.lit(0.0), F.lit(0.0), [(0.0, 0.0), (1.0, 1.0)])


def plain_haversine(a, b):
    (lat1, lon1), (lat2, lon2) = [(math.radians(p), math.radians(q)) for p, q in (a, b)]
    x = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(x, 1.0)))


coordinate = st.tuples(st.floats(-89, 89), st.floats(-179, 179))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(coordinate, coordinate), min_size=5, max_size=40))
def test_distance_properties(spark, pairs):
    rows = spark.createDataFrame([(*a, *b) for a, b in pairs], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    a, b, c, d = (F.col(x) for x in "abcd")
    got = rows.select(
        haversine_km(a, b, c, d).alias("there"), haversine_km(c, d, a, b).alias("back"),
        haversine_km(a, b, a, b).alias("zero"), "a", "b", "c", "d",
    ).collect()
    for r in got:
        assert r["zero"] == 0
        assert r["there"] == pytest.approx(r["back"], abs=1e-9)
        assert r["there"] == pytest.approx(plain_haversine((r["a"], r["b"]), (r["c"], r["d"])), abs=1e-6, rel=1e-6)


def test_antipodes_are_finite(spark):
    row = points(spark, [(0.0, 0.0)]).select(
        haversine_km(F.lit(10.0), F.lit(20.0), F.lit(-10.0), F.lit(-160.0)).alias("d")
    ).first()
    assert row["d"] == pytest.approx(math.pi * 6371.0)


def test_circle_box_holds_the_circle():
    lat, lon = DEFAULTS.harbour_centre
    for km in (0.5, 5, 20):
        box = circle_box(lat, lon, km)
        for degree in range(0, 360, 5):
            bearing, angle = math.radians(degree), km / 6371.0
            up = math.asin(
                math.sin(math.radians(lat)) * math.cos(angle)
                + math.cos(math.radians(lat)) * math.sin(angle) * math.cos(bearing)
            )
            side = math.radians(lon) + math.atan2(
                math.sin(bearing) * math.sin(angle) * math.cos(math.radians(lat)),
                math.cos(angle) - math.sin(math.radians(lat)) * math.sin(up),
            )
            assert box.lat_min <= math.degrees(up) <= box.lat_max
            assert box.lon_min <= math.degrees(side) <= box.lon_max
    assert circle_box(89.99, 0.0, 20) is None
    assert circle_box(0.0, 179.99, 20) is None
