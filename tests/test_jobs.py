"""The command-line jobs, end to end: raw messages to reports."""

from datetime import timedelta

from pyspark.sql import functions as F

from wakeline.__main__ import main
from wakeline.functions.vessel import one_decimal
from wakeline.operators import normalize, visits
from wakeline.operators.rollups import rolled_timeline
from wakeline.operators.silence import silences
from wakeline.operators.timeline import bucketed
from wakeline.sources import fixture, readers, writers
from wakeline.streaming import movements, rollups, stateful


def test_raw_messages_to_reports(spark, sf, tmp_path):
    raw, events, lake, out = (str(tmp_path / n) for n in ("raw", "events", "lake", "out"))
    fixture.raw_ais(spark, sf).select("value").write.text(raw)
    main(["normalize", raw, events, "--checkpoint", str(tmp_path / "c1"), "--once"])
    main(["etl", events, lake, "--checkpoint", str(tmp_path / "c2"), "--once"])
    main(["report", lake, out, "--hours", "48"])

    expected = normalize.normalize_ais(fixture.raw_ais(spark, sf)).filter("lat <> 0 AND lon <> 0")
    table = readers.read_lake(spark, lake)
    columns = ["mmsi", "ship_name", "lat", "lon", "speed", "heading", "status"]
    assert table.count() == expected.count()
    assert table.select(columns).exceptAll(expected.select(columns)).count() == 0

    kpis = spark.read.parquet(f"{out}/fleet_kpis").first()
    assert kpis["vessels"] == table.select("ship_name").distinct().count() == 150
    assert spark.read.parquet(f"{out}/fleet").count() == 150
    timeline = spark.read.parquet(f"{out}/timeline")
    assert timeline.agg(F.sum(F.col("rows_in_port") + F.col("rows_moving") + F.col("rows_stopped"))).first()[0] == table.count()
    layers = spark.read.parquet(f"{out}/map_layers")
    assert layers.filter("layer = 'alert'").count() == spark.read.parquet(f"{out}/alerts").count()


def test_notices_quarantine_compaction_and_filters(spark, sf, tmp_path):
    events, lake, aside, out, notices = (str(tmp_path / n) for n in ("events", "lake", "aside", "out", "notices"))
    fixture.faulty_records(spark, sf).write.text(events)
    main(["etl", events, lake, "--checkpoint", str(tmp_path / "c1"), "--once", "--quarantine", aside])
    for _ in range(2):
        main(["notify", events, notices, "--checkpoint", str(tmp_path / "c2"), "--once"])
    kept = readers.read_lake(spark, lake)
    assert kept.count() + spark.read.parquet(aside).count() == 10_000
    keys = stateful.read_versions(spark, notices, stateful.NOTICE).select("alert_key")
    assert keys.count() == keys.distinct().count() > 0
    before = kept.count()
    main(["compact", lake, "2024-01-03"])
    assert readers.read_lake(spark, lake).count() == before
    main(["report", lake, out, "--status", "moving", "--zone", "outside", "--no-alerts", "--min-speed-kn", "1"])
    shown = spark.read.parquet(f"{out}/operational_table")
    assert shown.count() > 0 and shown.filter("status_category <> 'moving' OR speed < 1").count() == 0
    assert not (tmp_path / "out" / "alerts").exists()
    assert spark.read.parquet(f"{out}/map_layers").filter("layer = 'alert'").count() == 0


def test_movements_silences_and_traffic(spark, sf, tmp_path):
    events, moves, silent, counts = (str(tmp_path / n) for n in ("events", "moves", "silent", "counts"))
    writers.to_json_records(fixture.positions(spark, sf)).write.text(events)
    main(["movements", events, moves, "--checkpoint", str(tmp_path / "c1"), "--once"])
    main(["silences", events, silent, "--checkpoint", str(tmp_path / "c2"), "--once", "--limit-sec", "43200"])
    main(["traffic", events, counts, "--checkpoint", str(tmp_path / "c3"), "--once"])
    silver = fixture.silver(spark, sf)
    assert movements.read_stays(spark, moves).count() == visits.port_visits(silver).count()
    newest = silver.agg(F.max("timestamp")).first()[0] - timedelta(seconds=60)
    want = silences(silver, 43_200, F.lit(newest))
    got = stateful.read_versions(spark, silent, "ship_name STRING, silent_since TIMESTAMP")
    assert got.exceptAll(want.select(*got.columns)).count() == want.select(*got.columns).exceptAll(got).count() == 0
    rolled = rolled_timeline(rollups.read_sketches(spark, counts), 30)
    assert rolled.exceptAll(bucketed(silver, 30)).count() == bucketed(silver, 30).exceptAll(rolled).count() == 0


def test_one_decimal_rounds_like_c(spark):
    values = [0.25, 0.35, 0.45, 2.5, 1234.05, 0.05, 0.15, 9.95, 10.0, -0.25]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    assert [r[0] for r in df.select(one_decimal(F.col("x"))).collect()] == [f"{v:.1f}" for v in values]


def test_columns_added_later_read_as_null(spark, sf, tmp_path):
    fixture.silver(spark, sf).select("ship_name", "lat").write.parquet(str(tmp_path / "old"))
    old = readers.read_table(spark, str(tmp_path / "old"), "ship_name STRING, lat DOUBLE, speed DOUBLE")
    assert old.filter("speed IS NULL").count() == old.count() > 0
