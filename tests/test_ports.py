import math
import random

import pytest
from pyspark.sql import functions as F

from wakeline.functions.geo import in_polygon_column
from wakeline.operators import cells
from wakeline.operators.ports import _with_lists, assign_ports, nearest_index, nearest_ports
from wakeline.session import checkpointed

PORTS = [
    ("P1", 28.0, 28.3, -15.5, -15.2),
    ("P2", 28.25, 28.4, -15.3, -15.1),
    ("P3", -0.05, 0.05, -0.05, 0.05),
]
PORT_SCHEMA = "port STRING, lat_min DOUBLE, lat_max DOUBLE, lon_min DOUBLE, lon_max DOUBLE"


def positions(spark):
    rng = random.Random(1)
    rows = [(i, 28.0 + rng.randrange(50) / 100, -15.5 + rng.randrange(50) / 100) for i in range(600)]
    rows += [(i, 28.28, -15.28) for i in range(600, 1200)]  # one busy spot, in two ports
    rows += [(1200, 0.05, -0.05), (1201, 50.0, 50.0), (1202, None, 1.0)]
    return rows, spark.createDataFrame(rows, "event_id INT, lat DOUBLE, lon DOUBLE")


def expected(rows):
    out = []
    for i, lat, lon in rows:
        hits = [p for p, a, b, c, d in PORTS if lat is not None and a <= lat <= b and c <= lon <= d]
        out += [(i, p) for p in hits] or [(i, None)]
    return sorted(out, key=str)


def test_broadcast_and_salted_forms(spark):
    rows, df = positions(spark)
    ports = spark.createDataFrame(PORTS, PORT_SCHEMA)
    for limit, join in ((100_000, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            got = assign_ports(df, ports, broadcast_weight=limit).select("event_id", "port")
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert join in plan and "NestedLoop" not in plan and "Cartesian" not in plan
            assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_polygon_ports(spark):
    triangle = F.array(*[
        F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ((-15.5, 28.0), (-15.2, 28.0), (-15.5, 28.3))
    ])
    ports = spark.createDataFrame(PORTS[:1], PORT_SCHEMA).withColumn("polygon", triangle)
    spots = [(1, 28.05, -15.45), (2, 28.25, -15.25)]
    df = spark.createDataFrame(spots, "event_id INT, lat DOUBLE, lon DOUBLE")
    got = assign_ports(df, ports)
    assert {r["event_id"]: r["port"] for r in got.collect()} == {1: "P1", 2: None}
    assert "polygon" not in got.columns


def polygon_of(corners):
    return F.array(*[F.struct(F.lit(float(x)).alias("lon"), F.lit(float(y)).alias("lat")) for x, y in corners])


AREAS = {
    "berth": [(-15.41, 28.13), (-15.409, 28.13), (-15.409, 28.131), (-15.41, 28.131)],
    "bay": [(-16, 27), (-14, 27), (-14, 28), (-15, 27.5), (-16, 28)],
    "ocean": [(-80, -60), (20, -60), (10, 0), (-30, 10), (-15, 60), (-60, 50)],
    "half": [(-180, -90), (0, -90), (0, 90), (-180, 90)],
    "sliver": [(-170, 10), (170, 10.000001), (170, 10)],
}


def areas(spark):
    rows = [(n, min(y for _, y in c), max(y for _, y in c), min(x for x, _ in c), max(x for x, _ in c)) for n, c in AREAS.items()]
    one = spark.createDataFrame([(n, *map(float, r)) for n, *r in rows], PORT_SCHEMA)
    kinds = F.coalesce(*[F.when(F.col("port") == n, polygon_of(c)) for n, c in AREAS.items()])
    return one.withColumn("polygon", kinds)


def test_cells_of_an_area_are_bounded_whatever_its_size(spark):
    held = cells.cover(areas(spark)).select("level", F.explode("held").alias("h")).select("level", "h.*")
    counts = {r["port"]: r for r in held.groupBy("port").agg(F.count("*").alias("n"), F.count_if("inner").alias("inner"), F.max("level").alias("finest")).collect()}
    assert set(counts) == set(AREAS)
    assert max(r["n"] for r in counts.values()) <= 700, counts
    assert counts["ocean"]["n"] < 300 and counts["ocean"]["inner"] > 20
    assert counts["berth"]["finest"] > counts["bay"]["finest"] > counts["ocean"]["finest"]


def test_nested_and_huge_areas_by_the_plain_test(spark):
    rng = random.Random(2)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(1500)] + [(rng.uniform(26.9, 28.2), rng.uniform(-16.2, -13.8)) for _ in range(1500)]
    rows += [(y, x) for c in AREAS.values() for x, y in c] + [(10.0, 0.0), (28.125, -15.46875), (0.0, 0.0), (90.0, 180.0), (float("nan"), 1.0), (None, None)]
    df = spark.createDataFrame([(i, None if y is None else float(y), None if x is None else float(x)) for i, (y, x) in enumerate(rows)], "id INT, lat DOUBLE, lon DOUBLE")
    zones = areas(spark)
    inside = F.col("lat").between(F.col("lat_min"), F.col("lat_max")) & F.col("lon").between(F.col("lon_min"), F.col("lon_max"))
    inside = inside & in_polygon_column(F.col("lat"), F.col("lon"), F.col("polygon"))
    plain = df.join(F.broadcast(zones), inside, "left").select("id", "port")
    want = sorted(map(str, plain.collect()))
    assert len(want) > len(rows)
    for limit in (1_000_000, 0):
        assert sorted(map(str, assign_ports(df, zones, broadcast_weight=limit).select("id", "port").collect())) == want


def test_few_positions_need_the_exact_test(spark):
    """In a cover most positions of the area lie in inner cells."""
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.uniform(-60, 60), rng.uniform(-80, 20)) for _ in range(3000)], "lat DOUBLE, lon DOUBLE")
    table = checkpointed(cells.cover(areas(spark).filter("port = 'ocean'")))
    rows = cells.with_cells(df, table, "held").select(F.explode("held").alias("h"))
    hit = rows.agg(F.count("*").alias("all"), F.count_if(~F.col("h.inner")).alias("border")).first()
    assert 1000 < hit["all"] and hit["border"] < 0.3 * hit["all"]


def test_areas_that_contain_nothing(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0)], "id INT, lat DOUBLE, lon DOUBLE")
    odd = [("upside down", 2.0, 0.0, 0.0, 2.0), ("unknown", None, 2.0, 0.0, 2.0)]
    ports = spark.createDataFrame(odd, PORT_SCHEMA)
    assert [r["port"] for r in assign_ports(df, ports).collect()] == [None]
    assert [r["port"] for r in assign_ports(df, ports.limit(0)).collect()] == [None]
    point = spark.createDataFrame([("point", 1.0, 1.0, 1.0, 1.0)], PORT_SCHEMA)
    assert [r["port"] for r in assign_ports(df, point).collect()] == ["point"]


def plain_km(a, b):
    (lat1, lon1), (lat2, lon2) = [(math.radians(p), math.radians(q)) for p, q in (a, b)]
    x = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(min(x, 1.0)), math.sqrt(max(0.0, 1 - x)))


HARBOURS = (
    [(f"H{i:03d}", 28 + (i % 7) / 50, -15.4 + (i // 7) / 45) for i in range(60)]
    + [("north pole", 90.0, 0.0), ("south", -89.5, 120.0), ("east", 5.0, 179.9), ("west", 5.3, -179.8), ("line", -20.0, 180.0)]
    + [(f"twin {i}", 40.0, 3.0) for i in range(8)]
)


@pytest.mark.parametrize("k, within, weight", [(1, None, 1_000_000), (3, None, 1_000_000), (3, None, 0), (2, 800.0, 1_000_000)])
def test_nearest_ports_by_brute_force(spark, k, within, weight):
    rng = random.Random(k)
    spots = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(150)]
    spots += [(28 + rng.random() / 5, -15.4 + rng.random() / 4) for _ in range(500)]
    spots += [(5.1, 179.99), (5.2, -179.99), (89.9, 170.0), (-90.0, 0.0), (90.0, 180.0), (-20.0, -180.0), (40.0, 3.0)]
    rows = [(i, *s) for i, s in enumerate(spots)] + [(-1, None, 1.0), (-2, 91.0, 0.0), (-3, float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "id INT, lat DOUBLE, lon DOUBLE")
    ports = spark.createDataFrame([*HARBOURS, ("nowhere", None, 0.0), ("beyond", 95.0, 0.0)], "port STRING, lat DOUBLE, lon DOUBLE")
    got = {}
    for r in nearest_ports(df, ports, k, within, candidates=5, crowd=20, broadcast_weight=weight).collect():
        got.setdefault(r["id"], []).append((r["port_rank"], r["port"], r["port_km"]))
    for i, lat, lon in rows:
        ranked = sorted((plain_km((lat, lon), h[1:]), h[0]) for h in HARBOURS)[:k] if i >= 0 else []
        ranked = [x for x in ranked if within is None or x[0] <= within]
        if not ranked:
            assert got[i] == [(None, None, None)]
            continue
        own = sorted(got[i])
        assert [o[0] for o in own] == list(range(1, len(ranked) + 1))
        for (_, name, km), (want, expected) in zip(own, ranked, strict=True):
            assert abs(km - want) < 1e-6 and (name == expected or abs(plain_km((lat, lon), next(h[1:] for h in HARBOURS if h[0] == name)) - want) < 1e-6)


def test_a_cell_lists_few_ports(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(28 + rng.random() / 5, -15.4 + rng.random() / 4) for _ in range(2000)], "lat DOUBLE, lon DOUBLE")
    ports = spark.createDataFrame(HARBOURS, "port STRING, lat DOUBLE, lon DOUBLE")
    listed = nearest_index(ports, df, candidates=6, crowd=10).select(F.size("held").alias("n")).collect()
    assert max(r["n"] for r in listed) <= 30 < len(HARBOURS) / 2 and len(listed) < 2000


def test_long_lists_are_shuffled_once(spark):
    """Lists too large to broadcast meet the positions in one join, however many levels cells are of."""
    rng = random.Random(4)
    spots = [(i, rng.uniform(20, 45), rng.uniform(-20, 5)) for i in range(100)] + [(1000 + i, -40.0 - i, 120.0) for i in range(9)]
    df = spark.createDataFrame([*spots, (-1, None, 1.0)], "id INT, lat DOUBLE, lon DOUBLE")
    ports = spark.createDataFrame(HARBOURS, "port STRING, lat DOUBLE, lon DOUBLE")
    cells = checkpointed(nearest_index(ports, df, 3, candidates=5, crowd=60))
    n, held, rows = cells.agg(F.count("*"), F.sum(F.size("held")), F.sum("rows")).first()
    assert n < held and rows == 109 and cells.select("level").distinct().count() > 1
    # copies of a list follow the positions of its cell and are no more rows of the answer
    listed = _with_lists(df, cells, n, part_rows=7)
    plan = listed._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 1
    got = {r["id"]: r["n"] for r in listed.select("id", F.size("_held").alias("n")).collect()}
    whole = {r["id"]: r["n"] for r in _with_lists(df, cells, held).select("id", F.size("_held").alias("n")).collect()}
    assert len(got) == 110 and {**got, -1: 0} == {**whole, -1: 0} and min(v for i, v in got.items() if i >= 0) >= 3


def test_no_ports_at_all(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0)], "id INT, lat DOUBLE, lon DOUBLE")
    none = spark.createDataFrame([], "port STRING, lat DOUBLE, lon DOUBLE")
    assert [tuple(r) for r in nearest_ports(df, none).collect()] == [(1, 1.0, 1.0, None, None, None)]
    assert nearest_ports(df.limit(0), none).count() == 0
