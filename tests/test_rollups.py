"""Mergeable counts against exact ones."""

from pyspark.sql import functions as F

from wakeline.operators import rollups, timeline
from wakeline.sources import fixture


def crowd(spark, vessels):
    """Every vessel three times, at times spread over a day."""
    seconds = F.col("id") * 7919 % 86_400
    return spark.range(3 * vessels).select(
        F.concat(F.lit("V"), F.col("id") % vessels).alias("ship_name"),
        F.timestamp_seconds(F.lit(1_704_067_200) + seconds).alias("timestamp"),
        (F.col("id") % 5 == 0).alias("in_port"),
        (F.col("id") % 40 / 10).alias("speed"),
    )


def test_few_vessels_are_counted_exactly(spark, sf):
    silver = fixture.silver(spark, sf)
    sketches = rollups.bucket_sketches(silver).persist()
    for minutes in (5, 10, 15, 30, 60):
        got, want = rollups.rolled_timeline(sketches, minutes), timeline.bucketed(silver, minutes)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    sketches.unpersist()


def test_many_vessels_are_within_the_stated_error(spark):
    positions = crowd(spark, 60_000)
    for lg_cells in (10, 14):
        sketches = rollups.bucket_sketches(positions, lg_cells=lg_cells).persist()
        for minutes in (30, 1440):
            got = {r["ts_bin"]: r for r in rollups.rolled_timeline(sketches, minutes).collect()}
            for r in timeline.bucketed(positions, minutes).collect():
                own = got[r["ts_bin"]]
                assert abs(own["vessels_total"] / r["vessels_total"] - 1) <= rollups.relative_error(lg_cells, 4)
                assert [own[c] for c in rollups.ROWS] == [r[c] for c in rollups.ROWS]
        sketches.unpersist()


def test_rows_without_time_or_name(spark):
    rows = [("A", "2024-01-01 00:01:00"), (None, "2024-01-01 00:02:00"), ("", "2024-01-01 00:03:00"), ("B", None), (None, "2024-01-01 01:00:00")]
    positions = spark.createDataFrame([(s, t, True, 1.0) for s, t in rows], "ship_name STRING, timestamp STRING, in_port BOOLEAN, speed DOUBLE")
    positions = positions.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    got = rollups.rolled_timeline(rollups.bucket_sketches(positions), 10).collect()
    assert [(r["vessels_total"], r["rows_in_port"]) for r in got] == [(2, 3), (0, 1)]


def test_a_window_reads_its_dates_only(spark, sf, tmp_path):
    path = str(tmp_path / "t")
    rollups.bucket_sketches(fixture.silver(spark, sf)).write.partitionBy("date").parquet(path)
    total = rollups.trailing_total(spark.read.schema(rollups.SKETCHES).parquet(path), 48)
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "ship_name" not in plan
    assert total.first()["vessels_total"] > 0


def test_no_rows(spark, sf):
    none = rollups.bucket_sketches(fixture.silver(spark, sf).limit(0))
    assert rollups.rolled_timeline(none, 10).count() == 0
    assert rollups.trailing_total(none, 48).first()["vessels_total"] in (0, None)
