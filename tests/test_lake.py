"""Readers, writers and the session."""

from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.config import Rectangle
from wakeline.functions.curve import hilbert_key
from wakeline.operators import clean, latest
from wakeline.plans import reports
from wakeline.session import object_store_conf, working_dir
from wakeline.sources import fixture, readers, writers


@pytest.fixture(scope="module")
def lake_path(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "table")
    rows = clean.to_lake(fixture.positions(spark, sf))
    writers.append_lake(rows.filter("date < '2024-01-15'"), path)
    writers.append_lake(rows.filter("date >= '2024-01-15'"), path)
    return path


def test_append_keeps_everything_and_the_schema(spark, sf, lake_path):
    lake = readers.read_lake(spark, lake_path)
    assert lake.columns == list(schemas.LAKE_COLUMNS)
    assert lake.count() == 9_688
    silver = fixture.silver(spark, sf).select(*schemas.POSITION_COLUMNS, "in_port")
    assert lake.select(*silver.columns).exceptAll(silver).count() == 0


def test_since_prunes_partitions(spark, lake_path):
    recent = readers.read_lake(spark, lake_path, since=date(2024, 1, 29))
    assert recent.select("date").distinct().count() == 2
    assert "PartitionFilters: [isnotnull(date" in recent._jdf.queryExecution().executedPlan().toString()


def test_few_files_per_date(spark, lake_path):
    files = readers.read_lake(spark, lake_path).select(F.input_file_name()).distinct().count()
    assert files <= 2 * 30


def test_missing_table_is_empty_but_other_errors_are_raised(spark, tmp_path):
    empty = readers.read_lake(spark, str(tmp_path / "nothing"))
    assert empty.count() == 0 and empty.columns == list(schemas.LAKE_COLUMNS)
    assert reports.fleet_snapshot(empty).count() == 0
    with pytest.raises(Exception, match="no-such-format"):
        readers.read_table(spark, str(tmp_path / "nothing"), fmt="no-such-format")


def test_source_from_environment(spark, lake_path, monkeypatch):
    monkeypatch.delenv("WAKELINE_LAKE", raising=False)
    monkeypatch.delenv("WAKELINE_SNAPSHOT", raising=False)
    with pytest.raises(ValueError):
        readers.read_lake(spark)
    monkeypatch.setenv("WAKELINE_LAKE", "/nowhere")
    monkeypatch.setenv("WAKELINE_SNAPSHOT", lake_path)
    assert readers.read_lake(spark).count() == 9_688


def test_wrong_schema_is_rejected_at_write(spark, tmp_path):
    with pytest.raises(AnalysisException):
        writers.append_lake(spark.range(3), str(tmp_path / "bad"))


def test_time_travel(spark, lake_path):
    lake = readers.read_lake(spark, lake_path)
    first = lake.filter("date < '2024-01-15'").agg(F.max("ingestion_time")).first()[0]
    then = latest.as_of(lake, F.lit(first))
    assert then.count() == lake.filter("date < '2024-01-15'").count()


def test_csv_has_a_header_and_no_index(spark, tmp_path):
    table = spark.createDataFrame([("A", 1.5), ("B, C", None)], "ship_name STRING, speed DOUBLE")
    path = writers.export_csv(table, str(tmp_path))
    assert path.startswith(str(tmp_path / "fleet_filtered_"))
    back = spark.read.schema(table.schema).option("header", True).csv(path)
    assert sorted(map(tuple, back.collect())) == [("A", 1.5), ("B, C", None)]


def test_published_records_keep_microseconds(spark, sf):
    record = writers.to_json_records(fixture.positions(spark, sf)).first()["value"]
    assert '"timestamp":"2024-01-01T00:00:07.179575' in record


def test_a_client_gets_a_bounded_result(spark):
    assert len(writers.client_rows(spark.range(5000), 10)) == 10


def test_object_store_settings():
    assert object_store_conf({}) == {}
    conf = object_store_conf({"WAKELINE_S3_ENDPOINT": "http://store:9000", "AWS_ACCESS_KEY_ID": "k", "AWS_SECRET_ACCESS_KEY": "s"})
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "k"
    assert "spark.hadoop.fs.s3a.access.key" not in object_store_conf({"WAKELINE_S3_ENDPOINT": "e"})


def test_working_folder_is_the_shared_one(spark):
    assert working_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")


def test_a_load_written_again_replaces_itself(spark, sf, tmp_path):
    rows = clean.to_lake(fixture.positions(spark, sf))
    for _ in range(2):
        writers.append_lake(rows, str(tmp_path / "lake"), load="one")
    assert readers.read_lake(spark, str(tmp_path / "lake")).count() == 9_688


def test_compaction_keeps_every_row(spark, sf, tmp_path):
    path = str(tmp_path / "lake")
    rows = clean.to_lake(fixture.positions(spark, sf)).filter("date IN ('2024-01-03', '2024-01-04')")
    for i in range(5):
        writers.append_lake(rows.filter(F.pmod("mmsi", F.lit(5)) == i), path)
    before = readers.read_lake(spark, path)
    want, day = before.count(), date(2024, 1, 3)
    files = before.filter(F.col("date") == F.lit(day)).select(F.input_file_name()).distinct().count()
    writers.compact_day(spark, path, day)
    after = readers.read_lake(spark, path)
    assert after.count() == want
    assert after.filter(F.col("date") == F.lit(day)).select(F.input_file_name()).distinct().count() < files
    kept = after.select("mmsi", "timestamp")
    assert kept.exceptAll(rows.select("mmsi", "timestamp")).count() == 0
    assert [f.name for f in Path(path, "date=2024-01-03").iterdir()] == ["load=compacted"]
    writers.compact_day(spark, path, day)
    assert readers.read_lake(spark, path).count() == want


def boxes_of_row_groups(path):
    """Least and greatest latitude and longitude of every row group of the table."""
    found = []
    for file in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            ends = [meta.row_group(g).column(names.index(c)).statistics for c in ("lat", "lon")]
            found.append((ends[0].min, ends[0].max, ends[1].min, ends[1].max))
    return found


def read_of(path, box):
    groups = boxes_of_row_groups(path)
    met = [g for g in groups if g[0] <= box.lat_max and g[1] >= box.lat_min and g[2] <= box.lon_max and g[3] >= box.lon_min]
    return len(met) / len(groups), len(groups)


SMALL_GROUPS = {"parquet.block.size": "4096", "parquet.page.size": "1024", "parquet.block.size.row.check.min": "10", "parquet.page.size.row.check.min": "10"}
QUAY = Rectangle(28.11, 28.14, -15.44, -15.41)


def test_a_box_reads_few_row_groups_of_a_clustered_table(spark, sf, tmp_path):
    day = clean.to_lake(fixture.positions(spark, sf)).withColumn("date", F.lit(date(2024, 1, 1)))
    shares = {}
    for clustered in (False, True):
        path = str(tmp_path / f"clustered-{clustered}")
        writers.append_lake(day, path, clustered=clustered, **SMALL_GROUPS)
        shares[clustered], n = read_of(path, QUAY)
        assert n > 40
        lake = spark.read.parquet(path)
        assert lake.drop("ingestion_time", "load").exceptAll(day.drop("ingestion_time").select(*[c for c in lake.columns if c not in ("ingestion_time", "load")])).count() == 0
        inside = clean.within_box(readers.read_lake(spark, path), QUAY)
        assert inside.count() == clean.within_box(day, QUAY).count() > 100
        assert "GreaterThanOrEqual(lat" in inside._jdf.queryExecution().executedPlan().toString()
    assert shares[True] < 0.2 < shares[False]


def test_compaction_lays_a_day_out_along_the_curve(spark, sf, tmp_path):
    path = str(tmp_path / "lake")
    day = clean.to_lake(fixture.positions(spark, sf)).withColumn("date", F.lit(date(2024, 1, 1)))
    for part in range(3):
        writers.append_lake(day.filter(F.col("mmsi") % 3 == part), path, **SMALL_GROUPS)
    before = readers.read_lake(spark, path).collect()
    assert read_of(path, QUAY)[0] > 0.2
    writers.compact_day(spark, path, date(2024, 1, 1), **SMALL_GROUPS)
    assert sorted(map(str, readers.read_lake(spark, path).collect())) == sorted(map(str, before))
    assert read_of(path, QUAY)[0] < 0.2


def test_neighbours_on_the_curve_are_neighbours_on_the_map(spark):
    n = 16
    grid = spark.range(n * n).select(F.floor(F.col("id") / n).alias("y"), (F.col("id") % n).alias("x"))
    middle = [(F.col(c) + 0.5) * span / n - span / 2 for c, span in (("y", 180.0), ("x", 360.0))]
    rows = grid.withColumn("key", hilbert_key(*middle, bits=4)).orderBy("key").collect()
    assert [r["key"] for r in rows] == list(range(n * n))
    assert all(abs(a["x"] - b["x"]) + abs(a["y"] - b["y"]) == 1 for a, b in zip(rows, rows[1:], strict=False))


def test_curve_of_odd_positions(spark):
    rows = [(None, 1.0), (1.0, None), (float("nan"), 1.0), (90.0, 180.0), (-90.0, -180.0), (1e9, -1e9)]
    got = [r[0] for r in spark.createDataFrame(rows, "lat DOUBLE, lon DOUBLE").select(hilbert_key(F.col("lat"), F.col("lon"))).collect()]
    assert got[:3] == [None] * 3 and all(0 <= k < 4**18 for k in got[3:])
