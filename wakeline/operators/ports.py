"""Assignment of positions to many ports, and the ports nearest to a position."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions.geo import EARTH_RADIUS_KM, haversine_km
from wakeline.operators.cells import (
    BROADCAST_WEIGHT, REFINE, SPLIT, STEP, cell_number, cell_size, contains, cover, weight_of, with_cells,
)
from wakeline.operators.lookup import SALTS
from wakeline.session import checkpointed

#: Added to every bound on a distance, far above rounding and far below any distance that counts.
MARGIN_KM = 1e-6
#: A cell in which more ports may be the nearest is split if it has a crowd of positions,
#: and one in which very many may be in any case, down to squares of 2.4 km.
CANDIDATES, CROWD, MANY = 24, 512, 4096
SMALLEST = 14
#: So many positions at most share one copy of a cell's list where lists are shuffled.
PART_ROWS = 10_000
CELL = ["level", "cy", "cx"]


def assign_ports(
    positions: DataFrame, ports: DataFrame, refine: int = REFINE, broadcast_weight: int = BROADCAST_WEIGHT
) -> DataFrame:
    """Positions with the columns of each port containing them (nulls if none).

    ``ports`` has ``port, lat_min, lat_max, lon_min, lon_max`` and optionally ``polygon``
    (ARRAY<STRUCT<lon, lat>>), tested inside its box; areas may lie in one another and be of any size. Positions
    are looked up by quadtree cell, never paired with every port, and need the exact test only in
    cells on a border. A job builds the cells beforehand.
    """
    cells = checkpointed(cover(ports, refine))
    lat, lon, polygons = F.col("lat"), F.col("lon"), "polygon" in ports.columns
    found = with_cells(positions, cells, "_held", weight_of(ports.columns), broadcast_weight)
    inside = F.filter("_held", lambda held: contains(held, lat, lon, polygons))
    hits = found.select(*positions.columns, F.explode_outer(inside).alias("_port"))
    return hits.select(*positions.columns, *[F.col("_port")[c].alias(c) for c in ports.columns if c != "polygon"])


def _valid(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))


def _centred(cells: DataFrame) -> DataFrame:
    """The part of every cell that lies on the globe: its middle and how far from it the cell reaches."""
    size = cell_size(F.col("level"))
    low, high = F.greatest(F.col("cy") * size, F.lit(-90.0)), F.least((F.col("cy") + 1) * size, F.lit(90.0))
    left, right = F.greatest(F.col("cx") * size, F.lit(-180.0)), F.least((F.col("cx") + 1) * size, F.lit(180.0))
    # along the meridian to the latitude, then along the widest parallel: no point is farther
    widest = F.when((low <= 0) & (high >= 0), 1.0).otherwise(F.cos(F.radians(F.least(F.abs(low), F.abs(high)))))
    reach = F.lit(EARTH_RADIUS_KM) * F.radians((high - low) / 2 + (right - left) / 2 * widest)
    on_globe = cells.filter((low <= high) & (left <= right))
    return on_globe.withColumns({"_lat": (low + high) / 2, "_lon": (left + right) / 2, "_reach": reach})


def _candidates(pairs: DataFrame, k: int, within_km: float | None) -> DataFrame:
    """Of the ports listed for a cell, those that may be among the ``k`` nearest of a point in it.

    With the k-th nearest port at distance d of the middle, and no point farther from the middle than r,
    no such port is farther from the middle than d + 2 r; nor than the limit + r, if there is one.
    """
    apart = haversine_km(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon"))
    measured = _centred(pairs).withColumn("_km", apart)
    if within_km is not None:
        measured = measured.filter(F.col("_km") <= F.col("_reach") + (within_km + MARGIN_KM))
    nearest = measured.withColumn("_place", F.row_number().over(Window.partitionBy(*CELL).orderBy("_km"))).filter(F.col("_place") <= k)
    bound = nearest.groupBy(*CELL).agg((F.max("_km") + 2 * F.max("_reach") + MARGIN_KM).alias("_bound"))
    kept = measured.join(bound, CELL).filter(F.col("_km") <= F.col("_bound"))
    return kept.select(*CELL, "rows", "port", "lat", "lon")


def _occupied(positions: DataFrame) -> DataFrame:
    """Number of positions per smallest cell."""
    lat, lon = F.col("lat"), F.col("lon")
    cells = [cell_number(lat, SMALLEST).alias("cy"), cell_number(lon, SMALLEST).alias("cx")]
    return positions.filter(_valid(lat, lon)).groupBy(*cells).agg(F.count("*").alias("rows"))


def _upwards(occupied: DataFrame, level: int) -> DataFrame:
    """The same for the cells of a higher level."""
    larger = [F.floor(F.col(c) / 2 ** (SMALLEST - level)).cast("long").alias(c) for c in ("cy", "cx")]
    return occupied.groupBy(*larger).agg(F.sum("rows").alias("rows")).withColumn("level", F.lit(level))


def nearest_index(
    ports: DataFrame, positions: DataFrame, k: int = 1, within_km: float | None = None, candidates: int = CANDIDATES, crowd: int = CROWD
) -> DataFrame:
    """Cells that hold all positions, each with its number of these (``rows``) and the ports (``port, lat, lon``)
    that can be among the ``k`` nearest of a point in it. No two cells overlap.

    It starts with a quarter of the globe and splits cells of more than ``candidates`` ports and ``crowd``
    positions, and in any case those of very many ports; cells without positions are
    dropped on the way. Distances are on the sphere, so poles and date line need no care. Of ports at one spot
    only the first ``k`` by name can count. Each round is one table, with a row per cell and candidate.
    """
    spot = Window.partitionBy("lat", "lon").orderBy("port")
    known = ports.filter(_valid(F.col("lat"), F.col("lon"))).select("port", F.col("lat").cast("double"), F.col("lon").cast("double"))
    known = known.withColumn("_place", F.row_number().over(spot)).filter(F.col("_place") <= k).drop("_place")
    occupied = checkpointed(_occupied(positions))
    # quarters of the globe, and the slivers that only a pole or the date line itself lies in
    rows, columns = (F.array(*[F.lit(i).cast("long") for i in own]) for own in (range(-1, 2), range(-2, 3)))
    pairs = known.withColumn("level", F.lit(STEP)).withColumn("cy", F.explode(rows)).withColumn("cx", F.explode(columns))
    pairs = pairs.join(_upwards(occupied, STEP), CELL)
    offsets = F.sequence(F.lit(0), F.lit(SPLIT - 1))
    done: list[DataFrame] = []
    for level in range(STEP, SMALLEST + 1, STEP):
        kept = checkpointed(_candidates(pairs, k, within_km))
        n = F.count("*")
        split = kept.groupBy(*CELL).agg(((n > candidates) & (F.first("rows") > crowd) | (n > MANY)).alias("split"))
        large = split.filter("split")
        if level + STEP > SMALLEST or large.limit(1).count() == 0:
            done.append(kept)
            break
        done.append(kept.join(split.filter("NOT split"), CELL, "left_semi"))
        parts = kept.join(large, CELL, "left_semi").drop("rows").withColumn("level", F.lit(level + STEP))
        parts = parts.withColumn("cy", F.explode(F.transform(offsets, lambda i: F.col("cy") * SPLIT + i)))
        parts = parts.withColumn("cx", F.explode(F.transform(offsets, lambda i: F.col("cx") * SPLIT + i)))
        pairs = parts.join(_upwards(occupied, level + STEP), CELL)
    held = F.collect_list(F.struct("port", "lat", "lon")).alias("held")
    return reduce(DataFrame.unionByName, done).groupBy(*CELL).agg(F.first("rows").alias("rows"), held)


def _with_lists(positions: DataFrame, cells: DataFrame, broadcast_weight: int, part_rows: int = PART_ROWS) -> DataFrame:
    """``positions`` with ``_held``, what the cell around each of them lists.

    Lists are broadcast if all of them together are small. Otherwise only the names of the cells are looked up,
    and one join by name brings positions and lists together: each is shuffled once, a list in as many
    copies as its cell has parts of ``part_rows`` positions.
    """
    if (cells.agg(F.sum(F.size("held"))).first()[0] or 0) <= broadcast_weight:
        return with_cells(positions, cells, "_held", broadcast_weight=broadcast_weight)
    parted = cells.withColumn("parts", F.ceil(F.col("rows") / part_rows))
    names = parted.select(*CELL, F.array(F.struct(*CELL, "parts")).alias("held"))
    placed = with_cells(positions, names, "_cell", broadcast_weight=broadcast_weight).withColumn("_cell", F.get("_cell", F.lit(0)))
    # positions outside all cells find no list, but are spread over tasks as well
    parts = F.coalesce("_cell.parts", F.lit(SALTS).cast("long"))
    placed = placed.withColumn("_part", F.pmod(F.xxhash64(*positions.columns, F.spark_partition_id()), parts))
    lists = parted.select(
        *[F.col(c).alias(f"_{c}") for c in CELL], F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("_copy"), F.col("held").alias("_held")
    )
    match = F.col("_part") == F.col("_copy")
    for c in CELL:
        match = match & (F.col(f"_cell.{c}") == F.col(f"_{c}"))
    return placed.join(lists, match, "left").select(*positions.columns, "_held")


def nearest_ports(
    positions: DataFrame,
    ports: DataFrame,
    k: int = 1,
    within_km: float | None = None,
    candidates: int = CANDIDATES,
    crowd: int = CROWD,
    broadcast_weight: int = BROADCAST_WEIGHT,
) -> DataFrame:
    """Positions with each of their ``k`` nearest ports: ``port``, ``port_rank`` (from 1) and ``port_km``.

    Equal distances are ordered by name. With ``within_km`` farther ports do not count. A position without usable
    coordinates, or without a port that counts, stays as one row with nulls. ``ports`` has ``port, lat, lon``; those
    without usable coordinates are left out. Positions are looked up by cell and measured against
    the ports listed there. Positions are read twice: to see which cells they lie in, and to be measured.
    """
    cells = checkpointed(nearest_index(ports, positions, k, within_km, candidates, crowd))
    lat, lon = F.col("lat"), F.col("lon")
    found = _with_lists(positions, cells, broadcast_weight)
    measured = F.transform("_held", lambda p: F.struct(haversine_km(lat, lon, p["lat"], p["lon"]).alias("km"), p["port"].alias("port")))
    near = F.slice(F.sort_array(measured), 1, k)
    if within_km is not None:
        near = F.filter(near, lambda p: p["km"] <= within_km)
    near = F.when(_valid(lat, lon), near)
    ranked = found.select(*positions.columns, F.posexplode_outer(near).alias("_place", "_port"))
    return ranked.select(
        *positions.columns, F.col("_port.port").alias("port"), (F.col("_place") + 1).alias("port_rank"), F.col("_port.km").alias("port_km")
    )
