"""Query registry: name to ``(spark, sf_dir) -> DataFrame``.

Each query applies the library to positions derived from the whole ``events``
table. Distances and averages are rounded so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.config import DEFAULTS, Rectangle, Settings
from wakeline.functions.times import hours
from wakeline.operators import (
    alerts as al,
    clean,
    drift,
    fleet as fl,
    kpis,
    latest as lt,
    names,
    normalize,
    ports,
    quality,
    rankings,
    rollups,
    silence,
    timeline,
    visits,
)
from wakeline.plans import reports
from wakeline.session import checkpointed, working_dir
from wakeline.sources import fixture, readers, snapshots, writers
from wakeline.streaming import alerts as st_alerts, etl, movements, rollups as st_rollups, silence as st_silence, stateful, traffic

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Second parameter sets: the default alert limits and freshness limits rarely
# split the fixture.
WIDE = DEFAULTS.but(speed_high_kn=5.0, near_port_km=8.0, stopped_near_port_km=8.0)
HOURLY = DEFAULTS.but(stale_warn_sec=6 * 3600, stale_bad_sec=24 * 3600)
NARROW = DEFAULTS.but(min_speed_kn=1.0, max_distance_km=9.0)
BY_MMSI = DEFAULTS.but(vessel_key="mmsi")

TIE = ("event_id",)


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def as_text(colour: str) -> Column:
    return F.array_join(F.col(colour).cast("array<string>"), ",")


def newest(silver: DataFrame) -> Column:
    return silver.agg(F.max("timestamp")).scalar()


def fleet_of(
    spark: SparkSession,
    sf_dir: str,
    settings: Settings = DEFAULTS,
    columns: Sequence[str] = reports.SNAPSHOT_COLUMNS,
) -> DataFrame:
    """Snapshot as of the table's newest time."""
    silver = fixture.silver(spark, sf_dir)
    return reports.fleet_snapshot(silver, settings, newest(silver), TIE, columns)


# --- positions -----------------------------------------------------------------


@query
def clean_positions(spark, d):
    return clean.drop_sentinel_positions(fixture.positions(spark, d))


@query
def bbox_positions(spark, d):
    return clean.within_box(clean.drop_unavailable_positions(fixture.positions(spark, d)))


# A box inside the data and a polygon that is not its own hull.
INNER = Rectangle(28.1, 28.2, -15.45, -15.35)
CORNER = (
    (-15.4805, 28.0705), (-15.3605, 28.0705), (-15.3605, 28.1305),
    (-15.4205, 28.1305), (-15.4205, 28.2205), (-15.4805, 28.2205),
)


@query
def bbox_inner(spark, d):
    return clean.within_box(clean.drop_unavailable_positions(fixture.positions(spark, d)), INNER)


@query
def geofence_concave(spark, d):
    rows = clean.drop_sentinel_positions(fixture.positions(spark, d))
    return clean.flag_harbour(rows, polygon=CORNER).select("event_id", "in_port")


@query
def geofence_flag(spark, d):
    return fixture.silver(spark, d).select("event_id", "in_port")


@query
def geofence_polygon(spark, d):
    rows = clean.drop_sentinel_positions(fixture.positions(spark, d))
    return clean.flag_harbour(rows, polygon=DEFAULTS.harbour.vertices()).select("event_id", "in_port")


@query
def port_assignment(spark, d):
    rows = fixture.silver(spark, d).select("event_id", "lat", "lon")
    return ports.assign_ports(rows, fixture.ports(spark, d)).select("event_id", "port")


@query
def zone_assignment(spark, d):
    """Zones from a few cables to an ocean, many in one another."""
    rows = fixture.silver(spark, d).select("event_id", "lat", "lon")
    return ports.assign_ports(rows, fixture.zones(spark, d)).select("event_id", "port")


@query
def nearest_ports(spark, d):
    """The three nearest of ports all over the globe."""
    found = ports.nearest_ports(fixture.world_positions(spark, d), fixture.world_ports(spark, d), k=3)
    rank = F.coalesce("port_rank", F.lit(0)).alias("port_rank")
    return found.select("event_id", "port", rank, F.round("port_km", 3).alias("port_km"))


@query
def nearest_port_in_reach(spark, d):
    """The nearest port of the harbour's own area for every position, if within 5 km."""
    boxes = fixture.ports(spark, d)
    spots = boxes.select("port", ((F.col("lat_min") + F.col("lat_max")) / 2 + 0.00037).alias("lat"), ((F.col("lon_min") + F.col("lon_max")) / 2 + 0.00071).alias("lon"))
    rows = fixture.silver(spark, d).select("event_id", "lat", "lon")
    return ports.nearest_ports(rows, spots, within_km=5.0, candidates=4, crowd=100).select("event_id", "port")


@query
def normalize_ais(spark, d):
    return normalize.normalize_ais(fixture.raw_ais(spark, d), F.col("timestamp"))


@query
def ingest_outcomes(spark, d):
    return normalize.ingest_outcomes(fixture.raw_ais(spark, d))


@query
def ingest_outcomes_malformed(spark, d):
    """Every 211th message is cut off."""
    raw = fixture.raw_ais(spark, d)
    cut = F.when(F.col("event_id") % 211 == 0, F.substring("value", 1, 40)).otherwise(F.col("value"))
    return normalize.ingest_outcomes(raw.withColumn("value", cut))


@query
def normalize_area(spark, d):
    """Only messages from an area, as the feed may be asked for."""
    return clean.within_box(normalize_ais(spark, d), INNER)


@query
def nav_status_counts(spark, d):
    return normalize_ais(spark, d).groupBy("status").agg(F.count("*").alias("messages"))


@query
def json_roundtrip(spark, d):
    return clean.parse_events(writers.to_json_records(fixture.positions(spark, d)))


# --- latest position -------------------------------------------------------------


@query
def latest_vessels(spark, d):
    return rounded(
        reports.fleet_snapshot(
            fixture.silver(spark, d), ties=TIE, as_of=F.col("timestamp")
        ).select(
            "ship_name", "lat", "lon", "speed", "heading", "status", "in_port", "timestamp",
            "distance_to_port_km", "status_category",
        ),
        "distance_to_port_km",
    )


@query
def latest_by_mmsi(spark, d):
    return lt.latest_per_vessel(
        fixture.silver(spark, d), key="mmsi", ties=TIE,
        columns=("mmsi", "ship_name", "lat", "lon", "speed", "in_port", "timestamp", "event_id"),
    )


@query
def latest_vessels_sql(spark, d):
    """The greatest row per vessel as an aggregate in SQL; ``rn`` is its rank."""
    return spark.sql(
        """
        SELECT newest.*, 1 AS rn
        FROM (SELECT max_by(struct(ship_name, lat, lon, speed, heading, status, in_port, timestamp),
                            struct(timestamp, event_id)) AS newest
              FROM {positions} GROUP BY ship_name)
        """,
        positions=fixture.silver(spark, d),
    )


@query
def latest_as_of(spark, d):
    arrived = fixture.silver(spark, d).withColumn(
        "ingestion_time",
        F.col("timestamp") + F.make_dt_interval(mins=(F.col("event_id") % 7).cast("int")),
    )
    then = lt.as_of(arrived, newest(arrived) - hours(24))
    return lt.latest_per_vessel(
        then, ties=TIE, columns=("ship_name", "lat", "lon", "timestamp", "ingestion_time", "event_id")
    )


@query
def upsert_latest(spark, d):
    columns = ("ship_name", "lat", "lon", "speed", "in_port", "timestamp", "event_id")
    silver = fixture.silver(spark, d).select(*columns)
    cut = newest(silver) - hours(48)
    base = lt.latest_per_vessel(silver.filter(F.col("timestamp") < cut), ties=TIE)
    return lt.merge_latest(base, silver.filter(F.col("timestamp") >= cut), ties=TIE)


@query
def enriched_fleet(spark, d):
    fleet = fleet_of(spark, d, HOURLY).withColumn("color", as_text("color"))
    return rounded(fleet, "distance_to_port_km", "size")


# --- filters and tables ------------------------------------------------------------

FILTER_OUTPUT = ("ship_name", "speed", "status_category", "distance_to_port_km")


def _filtered(spark, d, settings=DEFAULTS, **how):
    kept = fl.filter_fleet(fleet_of(spark, d, settings), settings, **how)
    return rounded(kept.select(*FILTER_OUTPUT), "distance_to_port_km")


@query
def fleet_filtered(spark, d):
    return _filtered(spark, d, NARROW, statuses=("moving", "stopped"))


@query
def vessel_search(spark, d):
    return _filtered(spark, d, search="sel 0+[1-4]")


@query
def vessel_search_literal(spark, d):
    return _filtered(spark, d, search="vessel 00", literal=True)


def _name_index(spark, d):
    path = working_dir(spark, "names")
    names.write_index(names.name_index(fixture.silver(spark, d)), path)
    return readers.read_table(spark, path, names.INDEX)


@query
def name_search_indexed(spark, d):
    """All positions of the vessels that a regular expression finds, by way of the trigram index."""
    rows = fixture.silver(spark, d).select("event_id", "ship_name")
    return names.search_positions(rows, _name_index(spark, d), "sel 0+[1-4]")


@query
def name_search_indexed_literal(spark, d):
    rows = fixture.silver(spark, d).select("event_id", "ship_name")
    return names.search_positions(rows, _name_index(spark, d), "vessel 00", literal=True)


@query
def zone_inside(spark, d):
    return _filtered(spark, d, zone="inside")


@query
def zone_outside(spark, d):
    return _filtered(spark, d, zone="outside")


@query
def quality_filter(spark, d):
    return _filtered(spark, d, HOURLY, min_quality=60)


@query
def operational_table(spark, d):
    fleet = fl.filter_fleet(fleet_of(spark, d))
    return rounded(rankings.operational_table(fleet), "distance_to_port_km")


@query
def top_speed(spark, d):
    fleet = fl.filter_fleet(fleet_of(spark, d))
    return rounded(rankings.top_speed(fleet), "distance_to_port_km")


@query
def stalest_vessels(spark, d):
    return rounded(rankings.stalest(fleet_of(spark, d)), "distance_to_port_km")


@query
def worst_offenders(spark, d):
    """The same report with vessels identified by MMSI."""
    return rounded(rankings.stalest(fleet_of(spark, d, BY_MMSI), BY_MMSI), "distance_to_port_km")


# --- figures -----------------------------------------------------------------------

KPI_COLUMNS = ("lat", "lon", "speed", "in_port", "timestamp")


@query
def fleet_kpis(spark, d):
    return rounded(kpis.fleet_kpis(fleet_of(spark, d, columns=KPI_COLUMNS)), "avg_speed", "fresh_pct")


@query
def fleet_kpis_hourly(spark, d):
    fleet = fleet_of(spark, d, HOURLY, KPI_COLUMNS)
    return rounded(kpis.fleet_kpis(fleet, HOURLY), "avg_speed", "fresh_pct")


@query
def fleet_kpis_catalog(spark, d):
    fleet = fleet_of(spark, d, HOURLY, KPI_COLUMNS)
    return rounded(kpis.catalog_kpis(fleet, HOURLY), "avg_speed", "data_quality")


@query
def status_counts(spark, d):
    return kpis.status_counts(fl.filter_fleet(fleet_of(spark, d, columns=KPI_COLUMNS)))


@query
def speed_histogram(spark, d):
    fleet = fl.filter_fleet(fleet_of(spark, d, columns=KPI_COLUMNS))
    return rounded(kpis.speed_histogram(fleet), "bin_from", "bin_to")


@query
def speed_vs_distance(spark, d):
    fleet = fl.filter_fleet(fleet_of(spark, d, columns=KPI_COLUMNS))
    return rounded(kpis.speed_vs_distance(fleet), "distance_to_port_km")


@query
def freshness_bands(spark, d):
    return kpis.freshness_bands(fleet_of(spark, d, HOURLY, KPI_COLUMNS), HOURLY)


# --- traffic -----------------------------------------------------------------------


@query
def traffic_timeline(spark, d):
    return timeline.traffic_timeline(fixture.silver(spark, d))


def _timeline_variant(minutes: int, window_hours: int) -> Query:
    settings = DEFAULTS.but(bucket_minutes=minutes, history_hours=window_hours)
    return lambda spark, d: timeline.traffic_timeline(fixture.silver(spark, d), settings)


REGISTRY["traffic_timeline_5m"] = _timeline_variant(5, 48)
REGISTRY["traffic_timeline_15m"] = _timeline_variant(15, 24)
REGISTRY["traffic_timeline_30m"] = _timeline_variant(30, 6)


@query
def traffic_history(spark, d):
    """Every bucket of the table."""
    return timeline.bucketed(fixture.silver(spark, d), DEFAULTS.bucket_minutes)


def _sketches(spark, d):
    """Sketches of five-minute buckets, written once."""
    path = working_dir(spark, "sketches")
    rollups.bucket_sketches(fixture.silver(spark, d)).write.partitionBy("date").parquet(path)
    return readers.read_table(spark, path, rollups.SKETCHES)


def _rolled(minutes: int) -> Query:
    return lambda spark, d: rollups.rolled_timeline(_sketches(spark, d), minutes)


for _minutes in (5, 10, 15, 30):
    REGISTRY[f"traffic_rollup_{_minutes}m"] = _rolled(_minutes)


@query
def traffic_rollup_48h(spark, d):
    """All vessels of the last 48 hours, from the same sketches."""
    return rollups.trailing_total(_sketches(spark, d), 48)


# --- alerts ------------------------------------------------------------------------

ALERT_OUTPUT = ("ship", "priority", "priority_rank", "type", "speed", "distance", "time")
# No age is needed, so the scan for the newest time is left out.
ALERT_INPUT = ("lat", "lon", "speed", "in_port", "timestamp")


def _alert_fleet(spark, d):
    silver = fixture.silver(spark, d)
    return fl.filter_fleet(
        reports.fleet_snapshot(silver, as_of=F.col("timestamp"), ties=TIE, columns=ALERT_INPUT)
    )


def _alerts(spark, d, settings):
    alerts = al.ordered_alerts(al.find_alerts(_alert_fleet(spark, d), settings))
    return rounded(alerts.select(*ALERT_OUTPUT), "distance")


@query
def alerts_default(spark, d):
    return _alerts(spark, d, DEFAULTS)


@query
def alerts_wide(spark, d):
    return _alerts(spark, d, WIDE)


@query
def alert_messages(spark, d):
    return al.find_alerts(_alert_fleet(spark, d), WIDE).select("ship", "message")


@query
def alert_kpis(spark, d):
    return al.alert_kpis(al.find_alerts(_alert_fleet(spark, d), WIDE))


@query
def stale_alerts(spark, d):
    return al.stale_alerts(fleet_of(spark, d, HOURLY, KPI_COLUMNS), HOURLY)


@query
def alerting_vessels(spark, d):
    # Both join sides come from the snapshot, so it is computed once beforehand.
    fleet = checkpointed(_alert_fleet(spark, d))
    rows = al.alerting_vessels(fleet, al.find_alerts(fleet, WIDE))
    return rounded(rows.select(*FILTER_OUTPUT), "distance_to_port_km")


@query
def quiet_vessels(spark, d):
    fleet = checkpointed(_alert_fleet(spark, d))
    rows = al.quiet_vessels(fleet, al.find_alerts(fleet, WIDE))
    return rounded(rows.select(*FILTER_OUTPUT), "distance_to_port_km")


@query
def map_layers(spark, d):
    layers = reports.map_layers(_alert_fleet(spark, d), WIDE)
    return rounded(layers.withColumn("color", as_text("color")), "radius")


@query
def alert_dedup(spark, d):
    """Rules over every position, one row per notification key."""
    fleet = fl.enrich(fixture.silver(spark, d), WIDE, F.col("timestamp"))
    return al.distinct_alerts(al.find_alerts(fleet, WIDE))


@query
def alert_dedup_repeated(spark, d):
    """As above with a third of all positions reported twice."""
    silver = fixture.silver(spark, d)
    twice = silver.unionByName(silver.filter("event_id % 3 = 0"))
    return al.distinct_alerts(al.find_alerts(fl.enrich(twice, WIDE, F.col("timestamp")), WIDE))


# --- data quality --------------------------------------------------------------------


@query
def contract_violations(spark, d):
    return quality.violation_counts(fixture.positions(spark, d))


@query
def valid_positions(spark, d):
    return quality.valid_positions(fixture.positions(spark, d))


@query
def quarantine(spark, d):
    rows = quality.quarantine(fixture.positions(spark, d))
    return rows.select("event_id", F.array_join("violations", ",").alias("violations"))


# --- port entry and exit ----------------------------------------------------------------


@query
def port_transitions(spark, d):
    return visits.port_transitions(fixture.silver(spark, d), tie="event_id")


@query
def port_visits(spark, d):
    return visits.port_visits(fixture.silver(spark, d), tie="event_id")


# --- lake and export ------------------------------------------------------------------


def _written_lake(spark, d):
    path = working_dir(spark, "lake")
    writers.append_lake(clean.to_lake(fixture.positions(spark, d)), path)
    return readers.read_lake(spark, path)


@query
def rows_by_date(spark, d):
    counts = _written_lake(spark, d).groupBy("date").agg(F.count("*").alias("positions"))
    return counts.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "positions")


@query
def lake_mixed_writers(spark, d):
    """Half of the table streamed, half appended, the streamed half run twice."""
    root = working_dir(spark, "lake-mixed")
    rows = fixture.positions(spark, d)
    writers.publish(rows.filter("event_id % 2 = 0"), f"{root}/landing")
    etl.start_etl(readers.stream_text(spark, f"{root}/landing"), f"{root}/lake", f"{root}/checkpoint", every=None).awaitTermination()
    writers.append_lake(clean.to_lake(rows.filter("event_id % 2 = 1")), f"{root}/lake")
    etl.start_etl(readers.stream_text(spark, f"{root}/landing"), f"{root}/lake", f"{root}/checkpoint", every=None).awaitTermination()
    lake = readers.read_lake(spark, f"{root}/lake").filter("ingestion_time IS NOT NULL")
    return lake.select(*schemas.POSITION_COLUMNS, "in_port", F.date_format("date", "yyyy-MM-dd").alias("date"))


@query
def lake_timeline(spark, d):
    """Timeline on the partitioned table: dates outside the window are not read."""
    return timeline.traffic_timeline(_written_lake(spark, d))


@query
def lake_box(spark, d):
    """A box of the table laid out along a curve over the map."""
    path = working_dir(spark, "lake-curve")
    writers.append_lake(clean.to_lake(fixture.positions(spark, d)), path, clustered=True)
    inside = clean.within_box(readers.read_lake(spark, path), INNER)
    return inside.select(*schemas.POSITION_COLUMNS, "in_port", F.date_format("date", "yyyy-MM-dd").alias("date"))


@query
def csv_export_roundtrip(spark, d):
    table = rankings.operational_table(fl.filter_fleet(fleet_of(spark, d)))
    path = writers.export_csv(table, working_dir(spark, "export"))
    back = spark.read.schema(table.schema).option("header", True).csv(path)
    return rounded(back, "distance_to_port_km")


# --- streams: run to completion over the whole table, then read back -----------------------


@query
def stream_etl(spark, d):
    root = working_dir(spark, "stream-etl")
    writers.publish(fixture.positions(spark, d), f"{root}/landing")
    records = readers.stream_text(spark, f"{root}/landing")
    etl.start_etl(records, f"{root}/lake", f"{root}/checkpoint", every=None).awaitTermination()
    lake = readers.read_lake(spark, f"{root}/lake")
    return lake.select(
        *schemas.POSITION_COLUMNS, "in_port", F.date_format("date", "yyyy-MM-dd").alias("date")
    )


@query
def stream_quarantine(spark, d):
    """Records kept and records set aside per broken rule, of a feed with bad records."""
    root = working_dir(spark, "stream-quarantine")
    fixture.faulty_records(spark, d).write.text(f"{root}/landing")
    records = readers.stream_text(spark, f"{root}/landing")
    out = (f"{root}/lake", f"{root}/checkpoint")
    etl.start_etl(records, *out, every=None, quarantine=f"{root}/aside").awaitTermination()
    kept = readers.read_lake(spark, out[0]).select(F.lit("kept").alias("outcome"))
    aside = readers.read_table(spark, f"{root}/aside", "value STRING, violations ARRAY<STRING>")
    total = kept.unionAll(aside.select(F.lit("set aside"))).unionAll(aside.select(F.explode("violations")))
    return total.groupBy("outcome").agg(F.count("*").alias("records"))


def _silver_stream(spark, d, root, **how):
    events = fixture.stream_events(spark, d, f"{root}/landing", **how)
    return clean.to_silver(fixture.as_positions(events))


@query
def stream_timeline(spark, d):
    root = working_dir(spark, "stream-timeline")
    counts = traffic.stream_traffic(_silver_stream(spark, d, root, closing=True))
    sink = (f"{root}/table", f"{root}/checkpoint")
    writers.stream_to_table(counts, *sink, every=None, partition_by=None).awaitTermination()
    return readers.read_table(spark, sink[0], counts.schema)


@query
def stream_rollup(spark, d):
    """Events arrive in no order; the buckets are merged from what each micro-batch counted."""
    root = working_dir(spark, "stream-rollup")
    silver = _silver_stream(spark, d, root, shuffled=True)
    st_rollups.start_sketches(silver, f"{root}/table", f"{root}/checkpoint", every=None).awaitTermination()
    return rollups.rolled_timeline(st_rollups.read_sketches(spark, f"{root}/table"), 10)


def _movements(spark, d, **how):
    root = working_dir(spark, "stream-movements")
    silver = _silver_stream(spark, d, root, **how)
    target = (f"{root}/out", f"{root}/checkpoint")
    movements.start_movements(silver, *target, tie="event_id", every=None, buckets=8).awaitTermination()
    return f"{root}/out"


@query
def stream_transitions(spark, d):
    return movements.read_transitions(spark, _movements(spark, d))


@query
def stream_transitions_late(spark, d):
    """Events arrive in no order, and the first part of them twice."""
    return movements.read_transitions(spark, _movements(spark, d, shuffled=True, again=True))


@query
def stream_visits(spark, d):
    """Stays, from events that arrive in no order."""
    return movements.read_stays(spark, _movements(spark, d, shuffled=True))


SILENT_SEC, LATENESS_SEC = 12 * 3600, 3600


@query
def silences(spark, d):
    """Vessels not heard from for twelve hours, as known at the table's newest time."""
    silver = fixture.silver(spark, d)
    return silence.silences(silver, SILENT_SEC, newest(silver))


@query
def stream_silences(spark, d):
    """The same by timers; the stream ends with one report a day after the others."""
    root = working_dir(spark, "stream-silences")
    silver = _silver_stream(spark, d, root, closing=True)
    st_silence.start_silence_notices(silver, f"{root}/out", f"{root}/checkpoint", SILENT_SEC, LATENESS_SEC, every=None).awaitTermination()
    return stateful.read_versions(spark, f"{root}/out", "ship_name STRING, silent_since TIMESTAMP, due_at TIMESTAMP")


@query
def lake_drift(spark, d):
    """Fields the schema does not foresee, after the stream to the lake and back, and a value in one of them."""
    root = working_dir(spark, "lake-drift")
    fixture.drifted_records(spark, d).write.text(f"{root}/landing")
    records = readers.stream_text(spark, f"{root}/landing")
    etl.start_etl(records, f"{root}/lake", f"{root}/checkpoint", every=None, extra=True).awaitTermination()
    lake = readers.read_lake(spark, f"{root}/lake", extra=True)
    port = lake.filter(F.try_variant_get("extra", "$.dest.port", "string") == "LPA")
    return drift.drifted_fields(lake).unionAll(port.agg(F.lit("dest.port"), F.count("*")))


@query
def stream_latest(spark, d):
    root = working_dir(spark, "stream-latest")
    rows = _silver_stream(spark, d, root).select(
        "ship_name", "lat", "lon", "speed", "in_port", "timestamp", "event_id"
    )
    latest = stateful.stream_latest(rows, ties=TIE)
    stateful.start_latest_snapshots(
        latest, f"{root}/out", f"{root}/checkpoint", ties=TIE, every=None
    ).awaitTermination()
    return snapshots.read_snapshot(spark, f"{root}/out", latest.schema)


@query
def snapshot_as_of_version(spark, d):
    """The fleet as it was after half of the micro-batches, read afterwards by version."""
    root = working_dir(spark, "stream-versions")
    rows = _silver_stream(spark, d, root).select("ship_name", "lat", "lon", "speed", "in_port", "timestamp", "event_id")
    latest = stateful.stream_latest(rows, ties=TIE)
    checkpoint = f"{root}/checkpoint"
    stateful.start_latest_snapshots(latest, f"{root}/out", checkpoint, ties=TIE, every=None).awaitTermination()
    versions = len(readers.found_paths(spark, f"{root}/out/of=*/v=*/_SUCCESS"))
    return snapshots.read_snapshot(spark, f"{root}/out", latest.schema, version=versions // 2 - 1)


@query
def stream_alert_dedup(spark, d):
    root = working_dir(spark, "stream-alerts")
    silver = _silver_stream(spark, d, root, again=True)
    notices = st_alerts.stream_high_alerts(silver, WIDE, remember="60 days")
    sink = (f"{root}/table", f"{root}/checkpoint")
    writers.stream_to_table(notices, *sink, every=None, partition_by=None).awaitTermination()
    table = readers.read_table(spark, sink[0], notices.schema)
    return table.select("priority", "ship", "type", "time", "alert_key")


@query
def stream_alert_notices(spark, d):
    """The first part of the table comes again at the end, late and repeated."""
    root = working_dir(spark, "stream-notices")
    silver = _silver_stream(spark, d, root, again=True)
    stateful.start_alert_notices(silver, f"{root}/out", f"{root}/checkpoint", WIDE, every=None).awaitTermination()
    notices = stateful.read_versions(spark, f"{root}/out", stateful.NOTICE)
    return notices.select("priority", "ship", "type", "time", "alert_key")
