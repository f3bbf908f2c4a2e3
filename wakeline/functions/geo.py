"""Distance and geofence expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.config import Rectangle

EARTH_RADIUS_KM = 6371.0  # fixed value
EDGE_TOLERANCE = 1e-15
BOX_MARGIN_DEG = 1e-6


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km. The chord term is clamped to 1 so that
    rounding at antipodal points cannot yield NaN."""
    half_lat = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2))
    half_lon = F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    chord = F.least(half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon, F.lit(1.0))
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def circle_box(lat: float, lon: float, km: float) -> Rectangle | None:
    """Smallest box holding every point within ``km``, a little widened; None where
    the circle reaches a pole or the date line and no such box exists."""
    angle = km / EARTH_RADIUS_KM
    up = math.degrees(angle)
    if abs(lat) + up >= 90:
        return None
    side = math.degrees(math.asin(math.sin(angle) / math.cos(math.radians(lat))))
    if abs(lon) + side >= 180:
        return None
    up, side = up + BOX_MARGIN_DEG, side + BOX_MARGIN_DEG
    return Rectangle(lat - up, lat + up, lon - side, lon + side)


def in_rectangle(lat: Column, lon: Column, box: Rectangle) -> Column:
    return lat.between(box.lat_min, box.lat_max) & lon.between(box.lon_min, box.lon_max)


def _edge_tests(lat: Column, lon: Column, ax, ay, bx, by) -> tuple[Column, Column]:
    """(point lies on the edge, an eastward ray from the point crosses it)."""
    cross = (bx - ax) * (lat - ay) - (by - ay) * (lon - ax)
    on_edge = (
        (F.abs(cross) <= EDGE_TOLERANCE)
        & lon.between(F.least(ax, bx), F.greatest(ax, bx))
        & lat.between(F.least(ay, by), F.greatest(ay, by))
    )
    # The crossing lies east of the point when the edge turns left of it going up,
    # right of it going down; no division, so level edges need no special case.
    crosses = ((ay > lat) != (by > lat)) & F.when(by > ay, cross > 0).otherwise(cross < 0)
    return on_edge, crosses


def in_polygon(lat: Column, lon: Column, vertices: Sequence[tuple[float, float]]) -> Column:
    """Inclusive point-in-polygon test for a constant polygon of (lon, lat) vertices,
    unrolled into one expression over its edges."""
    if len(vertices) < 3:
        raise ValueError("a polygon needs at least three vertices")
    on_any, crossings = F.lit(False), F.lit(0)
    for (ax, ay), (bx, by) in zip(vertices, [*vertices[1:], vertices[0]]):
        on_edge, crosses = _edge_tests(lat, lon, F.lit(ax), F.lit(ay), F.lit(bx), F.lit(by))
        on_any = on_any | on_edge
        crossings = crossings + crosses.cast("int")
    return on_any | (crossings % 2 == 1)


def in_polygon_column(lat: Column, lon: Column, polygon: Column) -> Column:
    """The same test for polygons held in a column of ARRAY<STRUCT<lon, lat>>."""
    edges = F.zip_with(
        polygon,
        F.concat(F.slice(polygon, 2, F.size(polygon) - 1), F.slice(polygon, 1, 1)),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )

    def fold(state: Column, edge: Column) -> Column:
        on_edge, crosses = _edge_tests(
            lat, lon, edge["a"]["lon"], edge["a"]["lat"], edge["b"]["lon"], edge["b"]["lat"]
        )
        return F.struct(
            (state["on"] | on_edge).alias("on"), (state["n"] + crosses.cast("int")).alias("n")
        )

    start = F.struct(F.lit(False).alias("on"), F.lit(0).alias("n"))
    return F.aggregate(edges, start, fold, lambda s: s["on"] | (s["n"] % 2 == 1))
