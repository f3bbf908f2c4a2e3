"""Every registered query against DuckDB on the same tables."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as catalog
from oracle import differences, duck
from wakeline.config import DEFAULTS, Rectangle
from wakeline.operators import clean
from wakeline.plans.oracles import ORACLES
from wakeline.plans.queries import REGISTRY
from wakeline.sources import fixture

QUERIES = {name: query for name, query in catalog.queries().items() if name in REGISTRY}


def test_every_query_has_a_check():
    assert set(QUERIES) == set(REGISTRY) == set(ORACLES)
    assert set(ORACLES) <= set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), ORACLES[name], sf) == []


@pytest.mark.parametrize("name", ["latest_vessels", "traffic_timeline", "port_visits", "alerts_wide", "quarantine"])
def test_matches_sql_small(spark, name):
    small = "/root/testdata/sf0.001"
    assert differences(QUERIES[name](spark, small), ORACLES[name], small) == []


def test_entry(spark):
    result = catalog.entry(spark)
    assert result.count() == 15
    assert result.columns[0] == "ship_name"


def test_comparison_notices_a_moved_geofence(spark, sf):
    moved = DEFAULTS.but(harbour=Rectangle(28.10, 28.17, -15.45, -15.39))
    wrong = fixture.silver(spark, sf, moved).select("event_id", "in_port")
    assert differences(wrong, ORACLES["geofence_flag"], sf) != []


# Figures taken by hand from the fixture definition, independent of both engines' plans.
TOTALS = {
    "positions": 10_000, "clean": 9_688, "in_port": 1_191, "vessels": 150,
    "port": 23, "moving": 95, "stopped": 32, "entries": 1_030, "exits": 1_022,
    "normalized": 7_853, "buckets_24h": 131,
}


def test_control_totals(spark, sf):
    positions = fixture.positions(spark, sf)
    silver = clean.to_silver(positions)
    kpis = QUERIES["fleet_kpis"](spark, sf).first()
    moves = QUERIES["port_transitions"](spark, sf).groupBy("event").count().collect()
    moves = {r["event"]: r["count"] for r in moves}
    assert {
        "positions": positions.count(), "clean": silver.count(),
        "in_port": silver.filter("in_port").count(), "vessels": kpis["vessels"],
        "port": kpis["in_port"], "moving": kpis["moving"], "stopped": kpis["stopped"],
        "entries": moves["entry"], "exits": moves["exit"],
        "normalized": QUERIES["normalize_ais"](spark, sf).count(),
        "buckets_24h": QUERIES["traffic_timeline"](spark, sf).count(),
    } == TOTALS


def test_bands_and_split_cover_everything(spark, sf):
    vessels = QUERIES["fleet_kpis"](spark, sf).first()["vessels"]
    bands = QUERIES["freshness_bands"](spark, sf).toPandas()
    assert bands["vessels"].sum() == vessels
    alerting = QUERIES["alerting_vessels"](spark, sf).count()
    quiet = QUERIES["quiet_vessels"](spark, sf).count()
    filtered = duck(ORACLES["speed_vs_distance"], sf)
    assert alerting > 0 and quiet > 0 and alerting + quiet == len(filtered)
    positions = fixture.positions(spark, sf).count()
    assert QUERIES["valid_positions"](spark, sf).count() + QUERIES["quarantine"](spark, sf).count() == positions


@pytest.mark.parametrize("missing", ["regex", "xxhash", "public_tokenizers", "corpus_pipeline", "wakeline.llm"])
def test_queries_do_without_what_only_texts_need(missing):
    code = (
        "import sys, warnings; warnings.simplefilter('ignore'); "
        f"sys.modules[{missing!r}] = None; import __spark_entry__ as e; from wakeline.plans.queries import REGISTRY; "
        "assert set(e.queries()) == set(REGISTRY), set(e.queries()) ^ set(REGISTRY)"
    )
    root = Path(catalog.__file__).parent
    subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": str(root)}, check=True, timeout=120)
