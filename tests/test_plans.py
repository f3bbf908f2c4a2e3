"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as catalog
from wakeline.operators import alerts, clean, fleet, kpis, latest, timeline
from wakeline.plans.queries import REGISTRY
from wakeline.sources import readers, writers
from wakeline.sources.fixture import positions


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def details_of(df) -> str:
    """The formatted plan, which does not cut long lists."""
    python = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return python.explainString(df._jdf.queryExecution(), "formatted")


QUERIES = {name: query for name, query in catalog.queries().items() if name in REGISTRY}
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert word not in plan


@pytest.fixture(scope="module")
def lake(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "table")
    writers.append_lake(clean.to_lake(positions(spark, sf)), path)
    return path


def test_filters_reach_the_scan(spark, lake):
    table = readers.read_lake(spark, lake)
    plan = details_of(clean.within_box(clean.drop_sentinel_positions(table)))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    for part in ("Not(EqualTo(lat,0.0))", "GreaterThanOrEqual(lat,27.0)", "LessThanOrEqual(lon,-13.0)"):
        assert part in pushed


def test_alert_area_reaches_the_scan(spark, lake):
    table = fleet.enrich(readers.read_lake(spark, lake))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", details_of(alerts.find_alerts(table))).group(1)
    assert "GreaterThanOrEqual(lat,28.09" in pushed and "LessThanOrEqual(lon,-15.36" in pushed


def test_only_needed_columns_are_read(spark, lake):
    table = readers.read_lake(spark, lake)
    snapshot = latest.latest_per_vessel(table, columns=("ship_name", "speed", "timestamp"))
    schema = re.search(r"ReadSchema: (\S+)", plan_of(snapshot)).group(1)
    assert schema == "struct<ship_name:string,speed:double,timestamp:timestamp>"


def test_one_shuffle_per_snapshot(spark, lake):
    table = readers.read_lake(spark, lake)
    assert plan_of(latest.latest_per_vessel(table)).count("Exchange hashpartitioning") == 1


def metrics(plan, name):
    """All values of a scan metric in the main plan."""
    found, queue = [], [plan]
    while queue:
        node = queue.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            queue.append(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            queue.append(node.plan())
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            metric = node.metrics().get(name)
            if metric.isDefined():
                found.append(metric.get())
        children = node.children()
        queue += [children.apply(i) for i in range(children.size())]
    return found


def test_timeline_reads_only_recent_dates(spark, lake):
    """Two of the thirty dates hold the trailing day."""
    recent = timeline.traffic_timeline(readers.read_lake(spark, lake))
    recent.collect()
    main = metrics(recent._jdf.queryExecution().executedPlan(), "numPartitions")
    assert [int(m.value()) for m in main] == [2]


def test_known_newest_day_leaves_other_dates_unplanned(spark, lake):
    table = readers.read_lake(spark, lake)
    day = readers.newest_day(spark, lake)
    recent = timeline.traffic_timeline(timeline.near(table, day, 24))
    assert sorted(map(str, recent.collect())) == sorted(map(str, timeline.traffic_timeline(table).collect()))
    assert readers.newest_day(spark, lake + "-none") is None
    partitions = [re.search(r"PartitionFilters: \[(.*?)\]", part).group(1) for part in details_of(recent).split("Scan parquet")[1:] if "PartitionFilters" in part]
    assert partitions and all("date" in p for p in partitions)


def test_histogram_has_no_window_over_all_rows(spark, sf):
    for table in (QUERIES["speed_histogram"](spark, sf), kpis.speed_histogram(fleet.filter_fleet(spark.createDataFrame([], FLEET)))):
        assert "Window" not in plan_of(table) and "Subquery" in plan_of(table)


FLEET = "ship_name STRING, speed DOUBLE, status_category STRING, distance_to_port_km DOUBLE"
