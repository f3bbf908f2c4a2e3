"""Streams over several micro-batches against the batch operators."""

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS
from wakeline.operators import alerts, clean, fleet, latest, rollups, timeline, visits
from wakeline.plans.queries import WIDE
from wakeline.sources import fixture, readers, snapshots, writers
from wakeline.streaming import alerts as st_alerts, etl, movements, rollups as st_rollups, stateful, traffic

PARTS = 4


@pytest.fixture(scope="module")
def landing(spark, sf, tmp_path_factory):
    """Positions as JSON text: PARTS files, in time order by file and by age."""
    root = tmp_path_factory.mktemp("landing")
    rows = fixture.positions(spark, sf)
    step = 10_000 // PARTS
    for i in range(PARTS):
        part = rows.filter((F.col("event_id") >= i * step) & (F.col("event_id") < (i + 1) * step))
        writers.to_json_records(part).coalesce(1).write.mode("append").text(str(root / "in"))
    return str(root / "in")


def silver_stream(spark, landing):
    return clean.to_silver(clean.parse_events(readers.stream_text(spark, landing, max_files=1)))


def same(a, b):
    columns = sorted(a.columns)
    a, b = a.select(columns), b.select(columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_etl_and_restart(spark, sf, landing, tmp_path):
    sink, checkpoint = str(tmp_path / "lake"), str(tmp_path / "ckpt")
    for _ in range(2):
        run = etl.start_etl(readers.stream_text(spark, landing, 1), sink, checkpoint, every=None)
        run.awaitTermination()
    assert run.exception() is None
    lake = readers.read_lake(spark, sink).drop("ingestion_time")
    batch = clean.to_lake(fixture.positions(spark, sf)).drop("ingestion_time")
    assert same(lake, batch)


def test_timer_trigger_and_clean_stop(spark, landing, tmp_path):
    run = etl.start_etl(readers.stream_text(spark, landing), str(tmp_path / "lake"), str(tmp_path / "c"), every="1 second")
    etl.run_until_stopped(run, timeout=5)
    assert not run.isActive
    assert readers.read_lake(spark, str(tmp_path / "lake")).count() == 9_688


def test_traffic(spark, sf, landing, tmp_path):
    counts = traffic.stream_traffic(silver_stream(spark, landing))
    args = (str(tmp_path / "t"), str(tmp_path / "c"))
    writers.stream_to_table(counts, *args, every=None, partition_by=None).awaitTermination()
    got = readers.read_table(spark, args[0], counts.schema)
    batch = timeline.bucketed(fixture.silver(spark, sf), 10)
    newest = batch.agg(F.max("ts_bin")).first()[0]
    closed = batch.filter(F.col("ts_bin") < F.lit(newest - timedelta(minutes=10)))
    assert got.exceptAll(batch).count() == 0
    assert closed.exceptAll(got).count() == 0


def test_latest_snapshots(spark, sf, landing, tmp_path):
    rows = silver_stream(spark, landing)
    state = stateful.stream_latest(rows)
    root = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new, the snapshot is still there
        stateful.start_latest_snapshots(state, root, str(tmp_path / "c"), every=None, buckets=16, retain=2).awaitTermination()
    got = snapshots.read_snapshot(spark, root, state.schema)
    assert snapshots.read_snapshot(spark, root + "-none", state.schema).count() == 0
    assert same(got, latest.latest_per_vessel(fixture.silver(spark, sf).drop("event_id")))
    # every bucket: two versions back and the newest part before them at most
    assert len(readers.found_paths(spark, f"{root}/of=16/v=*/bucket=*")) <= 3 * 16


REPORT = "ship_name STRING, timestamp TIMESTAMP, in_port BOOLEAN, place INT"


def follow(spark, batches, root, tie="place", runs=True):
    """Every list of reports as a micro-batch; with a new start of the query for each if ``runs``."""
    source, checkpoint = f"{root}/in", f"{root}/c"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, REPORT).coalesce(1).write.mode("append").parquet(source)
        if runs or i + 1 == len(batches):
            stream = spark.readStream.schema(REPORT).option("maxFilesPerTrigger", 1).parquet(source)
            movements.start_movements(stream, f"{root}/out", checkpoint, tie=tie, buckets=4, every=None).awaitTermination()
    return spark.read.schema(REPORT).parquet(source)


def check_movements(spark, reports, root, tie="place"):
    assert same(movements.read_transitions(spark, f"{root}/out"), visits.port_transitions(reports, tie=tie))
    assert same(movements.read_stays(spark, f"{root}/out"), visits.port_visits(reports, tie=tie))
    log = stateful.read_versions(spark, f"{root}/out/changes", movements.changes_schema().add("sign", "integer"))
    net = log.groupBy("ship_name", "timestamp", "event", "entry_seen").agg(F.sum("sign").alias("n")).filter("n <> 0")
    assert net.filter("n <> 1").count() == 0
    assert same(net.drop("n"), visits.port_changes(visits.port_states(reports, tie=tie)))


def test_movements_in_order_and_restart(spark, sf, landing, tmp_path):
    root = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        movements.start_movements(silver_stream(spark, landing), root, str(tmp_path / "c"), every=None).awaitTermination()
    batch = fixture.silver(spark, sf)
    assert same(movements.read_transitions(spark, root), visits.port_transitions(batch))
    assert same(movements.read_stays(spark, root), visits.port_visits(batch))


@pytest.mark.parametrize("how", [{}, {"shuffled": True}])
def test_a_step_is_one_micro_batch(spark, sf, tmp_path, how):
    """However many files the table and its steps have; a late batch works out its days in one pass."""
    table = str(tmp_path / "table")
    fixture.read_events(spark, sf).repartition(8).write.parquet(f"{table}/events.parquet")
    events = fixture.stream_events(spark, table, str(tmp_path / "landing"), file_rows=100, **how)
    assert len(readers.found_paths(spark, str(tmp_path / "landing/*.parquet"))) >= 4 * 2
    root = str(tmp_path / "out")
    movements.start_movements(clean.to_silver(fixture.as_positions(events)), root, str(tmp_path / "c"), tie="event_id", every=None).awaitTermination()
    assert len(readers.found_paths(spark, f"{root}/changes/v=*")) == 4
    batch = fixture.silver(spark, sf)
    assert same(movements.read_transitions(spark, root), visits.port_transitions(batch, tie="event_id"))
    assert same(movements.read_stays(spark, root), visits.port_visits(batch, tie="event_id"))


def test_history_is_scanned_once(spark, tmp_path):
    t0, root = datetime(2024, 1, 1), str(tmp_path)
    follow(spark, [[("A", t0 + timedelta(hours=h), h % 3 == 0, 0) for h in range(60)]], root)
    late = movements._reports(spark.createDataFrame([("A", t0 + timedelta(hours=30, minutes=5), True, 0)], REPORT), "ship_name", "place")
    known = snapshots.read_snapshot(spark, f"{root}/out/state", movements._states(late, "ship_name").schema)
    slices = movements._slices(late.limit(0), late, known, "ship_name").persist()
    assert {(r["day"].day, r["settled"]) for r in slices.collect()} == {(1, False), (2, True), (3, True)}
    delta = movements._corrections(f"{root}/out", 1, late.limit(0), late, slices, "ship_name")
    plan = delta._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [" in line and "load#" in line for line in plan.splitlines()) == 1
    # inside from 30:00 to 31:00 anyway, so nothing differs
    assert delta.count() == 0


def test_late_reports_by_hand(spark, tmp_path):
    """Between two states, before the first report, across days, at the very time of another report."""
    t0 = datetime(2024, 1, 1)

    def at(hour, inside, ship="A", place=0):
        return (ship, t0 + timedelta(hours=hour), inside, place)

    batches = [
        [at(2, False), at(100, True), at(5, False, None), at(200, True, "B")],
        [at(50, True), at(101, True), at(6, True, None)],  # A entered earlier than it seemed
        [at(0, True), at(75, False), at(150, False)],  # a first report inside, an exit in between
        [at(75, True, place=1), at(150, True, place=1)],  # the same instants, decided the other way
        [at(199, False, "B"), at(5, True, None, 1)],
        [at(2, False), at(100, True)],  # nothing new
    ]
    reports = follow(spark, batches, str(tmp_path))
    check_movements(spark, reports, str(tmp_path))


@pytest.mark.parametrize("seed", [1, 2])
def test_shuffled_reports_end_like_a_batch(spark, tmp_path, seed):
    rng = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    rows = [(rng.choice(["A", "B", "hot", "hot", "hot", None]), t0 + timedelta(hours=rng.randrange(24 * 9)), rng.random() < 0.5, rng.randrange(3)) for _ in range(500)]
    batches = [rows[i : i + 100] for i in range(0, 500, 100)] + [rows[:60]]
    reports = follow(spark, batches, str(tmp_path), runs=False)
    check_movements(spark, reports, str(tmp_path))


def test_history_is_read_for_late_days_only(spark, tmp_path):
    """A late report makes the batch read its own and the neighbouring days, however many there are."""
    t0 = datetime(2024, 1, 1)
    days = [[("A", t0 + timedelta(days=d, hours=h), h % 2 == 0, 0) for h in range(4)] for d in range(12)]
    root = str(tmp_path)
    follow(spark, [sum(days, []), [("A", t0 + timedelta(days=5, hours=1, minutes=30), True, 0)]], root)
    log = stateful.read_versions(spark, f"{root}/out/changes", movements.changes_schema().add("sign", "integer"))
    corrected = spark.read.parquet(f"{root}/out/changes/v=000000000001")
    assert {r["timestamp"] for r in corrected.collect()} == {t0 + timedelta(days=5, hours=1, minutes=30), t0 + timedelta(days=5, hours=2)}
    assert {r["sign"] for r in corrected.collect()} == {1, -1} and log.count() > 20


def test_movements_rerun_of_a_batch(spark, tmp_path):
    """The last batch again after its writes, before it was committed."""
    t0 = datetime(2024, 1, 1)
    root = str(tmp_path)
    batches = [[("A", t0 + timedelta(hours=i), i % 3 == 0, 0)] for i in (1, 9, 4, 6)]
    reports = follow(spark, batches, root)
    for commit in [f for f in Path(root, "c", "commits").iterdir() if f.name in ("3", ".3.crc")]:
        commit.unlink()
    stream = spark.readStream.schema(REPORT).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    movements.start_movements(stream, f"{root}/out", f"{root}/c", tie="place", buckets=4, every=None).awaitTermination()
    check_movements(spark, reports, root)


def test_a_version_writes_the_buckets_it_touches(spark, tmp_path):
    root = str(tmp_path / "t")

    def newest(before, changes):
        return latest.merge_latest(before, changes, key="k", order="at")

    fleet = spark.range(5000).select(F.concat(F.lit("V"), "id").alias("k"), F.lit(0).alias("at"), F.lit("x" * 50).alias("rest"))
    snapshots.upsert(fleet, root, 0, ["k"], newest, buckets=32)
    few = fleet.filter("k IN ('V1', 'V2', 'V77777')").withColumn("at", F.lit(1))
    for _ in range(2):  # the same version twice
        snapshots.upsert(few, root, 1, ["k"], newest, buckets=32)
    size = [sum(f.stat().st_size for f in Path(root, f"of=32/v={v:012d}").rglob("*.parquet")) for v in (0, 1)]
    assert size[1] < size[0] / 8
    got = snapshots.read_snapshot(spark, root, fleet.schema)
    assert got.count() == 5000 and got.filter("at = 1").count() == 2
    assert snapshots.read_snapshot(spark, root, fleet.schema, version=0).filter("at = 1").count() == 0
    with pytest.raises(ValueError, match="buckets"):
        snapshots.upsert(few, root, 2, ["k"], newest, buckets=16)
    snapshots.upsert(fleet.limit(0), root, 2, ["k"], newest, buckets=32)
    assert snapshots.read_snapshot(spark, root, fleet.schema).count() == 5000


def test_an_emptied_bucket_stays_empty(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, n INT")
    snapshots.upsert(rows, root, 0, ["k"], lambda a, b: a.unionByName(b), buckets=1)
    snapshots.upsert(rows.limit(1), root, 1, ["k"], lambda a, b: a.filter("false"), buckets=1)
    assert snapshots.read_snapshot(spark, root, rows.schema).count() == 0
    assert snapshots.read_snapshot(spark, root, rows.schema, version=0).count() == 2


def test_alert_notices(spark, sf, landing, tmp_path):
    notices = st_alerts.stream_high_alerts(silver_stream(spark, landing), WIDE, remember="40 days")
    args = (str(tmp_path / "t"), str(tmp_path / "c"))
    writers.stream_to_table(notices, *args, every=None, partition_by=None).awaitTermination()
    got = readers.read_table(spark, args[0], notices.schema)
    every = fleet.enrich(fixture.silver(spark, sf), WIDE, F.col("timestamp"))
    want = alerts.distinct_alerts(alerts.find_alerts(every, WIDE))
    assert got.count() == want.count() > 0
    assert same(got.select("alert_key"), want.select("alert_key"))


def test_late_alerts_are_notified_once(spark, sf, tmp_path):
    """Parts of the table in reverse order, one of them twice, over two runs."""
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    silver = fixture.silver(spark, sf)
    for part in (2, 0, 1, 0):
        silver.filter(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(silver.schema).option("maxFilesPerTrigger", 1).parquet(source)
        stateful.start_alert_notices(stream, root, str(tmp_path / "c"), WIDE, every=None).awaitTermination()
    got = stateful.read_versions(spark, root, stateful.NOTICE)
    want = alerts.distinct_alerts(alerts.find_alerts(fleet.enrich(silver, WIDE, F.col("timestamp")), WIDE))
    assert got.count() == want.count() > 0
    assert same(got.select("alert_key"), want.select("alert_key"))


def test_notices_look_up_their_own_keys_only(spark, sf, tmp_path):
    """The last of many batches has few alerts: earlier notices are neither read nor looked up."""
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    silver = fixture.silver(spark, sf)
    for part in (silver.filter("event_id % 20 <> 1"), silver.filter("event_id % 20 = 1")):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(silver.schema).option("maxFilesPerTrigger", 1).parquet(source)
        run = stateful.start_alert_notices(stream, root, str(tmp_path / "c"), WIDE, every=None)
        run.awaitTermination()
        state = run.lastProgress["stateOperators"][0]
    high = alerts.high_alerts(alerts.find_alerts(fleet.enrich(silver.filter("event_id % 20 = 1"), WIDE, F.col("timestamp")), WIDE)).count()
    assert run.lastProgress["numInputRows"] == silver.filter("event_id % 20 = 1").count()
    assert state["numRowsTotal"] > 10 * high > 0
    assert state["customMetrics"]["rocksdbGetCount"] <= 2 * high


def test_sketches_of_shuffled_batches(spark, sf, tmp_path):
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    events = fixture.stream_events(spark, sf, str(tmp_path / "in"), shuffled=True)
    silver = clean.to_silver(fixture.as_positions(events))
    for _ in range(2):  # the second run finds nothing new
        st_rollups.start_sketches(silver, path, checkpoint, every=None).awaitTermination()
    got = rollups.estimated(rollups.roll_up(st_rollups.read_sketches(spark, path), 10))
    assert same(got, timeline.bucketed(fixture.silver(spark, sf), 10))
    day = date(2024, 1, 5)
    before = st_rollups.read_sketches(spark, path).filter(F.col("date") == F.lit(day)).count()
    writers.compact_day(spark, path, day, arrange=rollups.merged_day)
    after = st_rollups.read_sketches(spark, path)
    assert after.filter(F.col("date") == F.lit(day)).count() < before
    assert same(rollups.estimated(rollups.roll_up(after, 10)), timeline.bucketed(fixture.silver(spark, sf), 10))


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        readers.stream_kafka(spark, "localhost:9", DEFAULTS.vessel_key)
