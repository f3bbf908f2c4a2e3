"""Quadtree cells over latitude and longitude: covers of areas, and rows looked up by their cell.

A cell of level n is a square of 360 / 2**n degrees, which a double holds exactly. A table of cells
has ``level, cy, cx`` and ``held``, an array of whatever belongs to the cell; cells of several
levels may lie inside one another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import in_polygon_column
from wakeline.functions.vessel import not_nan
from wakeline.operators.lookup import lookup_join
from wakeline.operators.once import evaluate_once

#: Levels in use are multiples of this, so that a row is looked up in few of them.
STEP = 2
SPLIT = 2**STEP
#: Squares of 38 metres.
FINEST = 20
#: How often the cells on an area's border are split; sets how much of it needs the exact test.
REFINE = 3
#: Areas are taken to reach this much farther when cells are judged: rounding never loses a row.
MARGIN_DEG = 1e-9
#: What a table of cells may hold to be broadcast: entries and corners of polygons.
BROADCAST_WEIGHT = 1_000_000

INNER, BORDER, OUTSIDE = "inner", "border", "outside"


def cell_size(level: Column | int) -> Column:
    return F.lit(360.0) / F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level)


def cell_number(degrees: Column, level: Column | int) -> Column:
    """Row or column of the cell; null for a missing coordinate or NaN."""
    return F.floor(not_nan(degrees) / cell_size(level)).cast("long")


def _edges(polygon: Column) -> Column:
    turned = F.concat(F.slice(polygon, 2, F.greatest(F.size(polygon) - 1, F.lit(0))), F.slice(polygon, 1, 1))
    return F.zip_with(polygon, turned, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _touches(edge: Column, south: Column, north: Column, west: Column, east: Column) -> Column:
    """The edge may have a point in the rectangle: their boxes overlap and the corners do not all
    lie on one side of its line."""
    ay, ax, by, bx = edge["a"]["lat"], edge["a"]["lon"], edge["b"]["lat"], edge["b"]["lon"]
    sides = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for y in (south, north) for x in (west, east)]
    return (
        (F.least(ay, by) <= north) & (F.greatest(ay, by) >= south) & (F.least(ax, bx) <= east) & (F.greatest(ax, bx) >= west)
        & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)
    )


def _kind(level: Column, cy: Column, cx: Column, polygon: Column | None) -> Column:
    """What a cell is to an area, which is a box and, if given, a polygon in it."""
    size = cell_size(level)
    margin = F.lit(MARGIN_DEG)
    south, west = cy * size - margin, cx * size - margin
    north, east = (cy + 1) * size + margin, (cx + 1) * size + margin
    low, high, left, right = (F.col(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max"))
    apart = (north < low) | (south > high) | (east < left) | (west > right)
    within = (south >= low) & (north <= high) & (west >= left) & (east <= right)
    if polygon is not None:
        crossed = F.exists(_edges(polygon), lambda edge: _touches(edge, south, north, west, east))
        middle = in_polygon_column((cy + 0.5) * size, (cx + 0.5) * size, polygon)
        apart = apart | (~crossed & ~middle)
        within = within & ~crossed & middle
    return F.when(F.coalesce(apart, F.lit(True)), OUTSIDE).when(within, INNER).otherwise(BORDER)


def cover(areas: DataFrame, refine: int = REFINE) -> DataFrame:
    """Cells that cover every area: ``level, cy, cx`` and ``held``, its areas there with ``inner``.

    ``areas`` has ``lat_min, lat_max, lon_min, lon_max`` and optionally ``polygon``. It starts with
    at most four cells of about its own size and splits those on its border ``refine`` times by sixteen:
    the number of its cells is bounded whether it is a berth or an ocean. ``inner`` cells lie in the area;
    elsewhere ``polygon`` is kept for the exact test.
    """
    polygon = F.col("polygon") if "polygon" in areas.columns else None
    extent = F.greatest(F.col("lat_max") - F.col("lat_min"), F.col("lon_max") - F.col("lon_min"))
    own = F.floor(F.log2(F.try_divide(F.lit(360.0), extent)) / STEP) * STEP
    level = F.greatest(F.lit(0), F.least(F.lit(FINEST - STEP * refine), F.coalesce(own, F.lit(FINEST)))).cast("int")
    kind = _kind(F.col("level"), F.col("cy"), F.col("cx"), polygon)

    def span(low: str, high: str) -> Column:
        margin = F.lit(MARGIN_DEG)
        return F.sequence(cell_number(F.col(low) - margin, F.col("level")), cell_number(F.col(high) + margin, F.col("level")))

    placed = areas.filter("lat_min <= lat_max AND lon_min <= lon_max").withColumn("level", level)
    placed = placed.withColumn("cy", F.explode(span("lat_min", "lat_max"))).withColumn("cx", F.explode(span("lon_min", "lon_max")))
    placed = evaluate_once(placed, kind, "kind").filter(F.col("kind") != OUTSIDE)
    offsets = F.sequence(F.lit(0), F.lit(SPLIT - 1))
    for _ in range(refine):
        child = F.flatten(
            F.transform(offsets, lambda i: F.transform(offsets, lambda j: F.struct(
                (F.col("level") + STEP).alias("level"), (F.col("cy") * SPLIT + i).alias("cy"), (F.col("cx") * SPLIT + j).alias("cx")
            )))
        )
        itself = F.array(F.struct("level", "cy", "cx"))
        split = F.when(F.col("kind") == BORDER, child).otherwise(itself)
        cells = placed.withColumns({"part": F.explode(split), "settled": F.col("kind") == INNER})
        cells = cells.withColumns({c: F.col("part")[c] for c in ("level", "cy", "cx")}).drop("part", "kind")
        judged = F.when(F.col("settled"), INNER).otherwise(kind)
        placed = evaluate_once(cells, judged, "kind").drop("settled").filter(F.col("kind") != OUTSIDE)
    inner = (F.col("kind") == INNER).alias("inner")
    parts = [F.when(F.col("kind") == BORDER, polygon).alias(c) if c == "polygon" else F.col(c) for c in areas.columns]
    return placed.groupBy("level", "cy", "cx").agg(F.collect_list(F.struct(*parts, inner)).alias("held"))


def with_cells(
    rows: DataFrame, cells: DataFrame, name: str, weight: Column | None = None, broadcast_weight: int = BROADCAST_WEIGHT
) -> DataFrame:
    """``rows`` (with ``lat, lon``) with ``name``: what the cells around each row hold, of all levels together.

    One left join per level that occurs, each on the row's cell there; no row is repeated or lost. Cells
    are broadcast only if all that they hold has been added up (``weight`` of each row of ``cells``,
    by default its entries) and is small; otherwise both sides are shuffled and salted. ``cells`` is read several
    times and should be a computed table.
    """
    per_level = cells.groupBy("level").agg(F.sum(F.size("held") if weight is None else weight).alias("weight")).collect()
    small = sum(r["weight"] for r in per_level) <= broadcast_weight
    kind = cells.schema["held"].dataType.simpleString()
    empty = F.array().cast(kind)
    columns, found = rows.columns, []
    for level in sorted(r["level"] for r in per_level):
        here = cells.filter(F.col("level") == level).select(F.col("cy").alias("_cy"), F.col("cx").alias("_cx"), F.col("held").alias(f"_held{level}"))
        placed = rows.withColumns({"_cy": cell_number(F.col("lat"), level), "_cx": cell_number(F.col("lon"), level)})
        joined = lookup_join(placed, here, ["_cy", "_cx"], small=small)
        rows = joined.select(*[F.col(f"r.{c}") for c in [*columns, *found]], f"_held{level}")
        found.append(f"_held{level}")
    held = F.concat(*[F.coalesce(F.col(c), empty) for c in found]) if found else empty
    return rows.select(*columns, held.alias(name))


def contains(held: Column, lat: Column, lon: Column, polygons: bool) -> Column:
    """An entry of ``cover`` contains the position: at once in an inner cell, else by the exact test."""
    exact = lat.between(held["lat_min"], held["lat_max"]) & lon.between(held["lon_min"], held["lon_max"])
    if polygons:
        exact = exact & in_polygon_column(lat, lon, held["polygon"])
    return F.coalesce(held["inner"] | exact, F.lit(False))


def weight_of(areas: Sequence[str]) -> Column:
    """Entries of a row of ``cover``, and the corners kept with them."""
    if "polygon" not in areas:
        return F.size("held")
    corners = F.transform("held", lambda h: F.coalesce(F.size(h["polygon"]), F.lit(0)) + 1)
    return F.aggregate(corners, F.lit(0), lambda total, n: total + n)
