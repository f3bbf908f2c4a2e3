"""The same queries in plain SQL, written independently of the Spark plans, for
checking against another engine on the same tables."""

from __future__ import annotations

from wakeline.sources.fixture import POSITION_EXPRESSIONS, WORLD_PORT, WORLD_POSITION

_POSITIONS = ", ".join(f"{e} AS {c}" for c, e in POSITION_EXPRESSIONS.items())

_DISTANCE = """2 * 6371.0 * atan2(
    sqrt(pow(sin(radians(28.14 - lat) / 2), 2)
         + cos(radians(lat)) * cos(radians(28.14)) * pow(sin(radians(-15.42 - lon) / 2), 2)),
    sqrt(1 - (pow(sin(radians(28.14 - lat) / 2), 2)
         + cos(radians(lat)) * cos(radians(28.14)) * pow(sin(radians(-15.42 - lon) / 2), 2))))"""


def _with(body: str, warn: int = 60, bad: int = 180, key: str = "ship_name") -> str:
    """Prefix ``body`` with positions, silver, newest, latest and fleet."""
    return f"""
WITH positions AS (SELECT {_POSITIONS} FROM events),
silver AS (
  SELECT *, lat >= 28.10 AND lat <= 28.18 AND lon >= -15.45 AND lon <= -15.39 AS in_port
  FROM positions
  WHERE lat IS NOT NULL AND lon IS NOT NULL AND lat <> 0 AND lon <> 0),
newest AS (SELECT max(timestamp) AS t FROM silver),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {key}
                                 ORDER BY timestamp DESC NULLS LAST, event_id DESC) AS rn
    FROM silver) ranked
  WHERE rn = 1),
located AS (
  SELECT latest.*, {_DISTANCE} AS distance,
         CASE WHEN in_port THEN 'port' WHEN speed > 0.5 THEN 'moving' ELSE 'stopped' END AS category,
         (epoch_us(newest.t) - epoch_us(timestamp)) / 1e6 AS age_sec,
         strftime(timestamp, '%H:%M:%S') AS time_display
  FROM latest, newest),
fleet AS (
  SELECT *, CASE WHEN age_sec <= {warn} THEN 100 WHEN age_sec <= {bad} THEN 60 ELSE 20 END AS score
  FROM located),
filtered AS (SELECT * FROM fleet WHERE speed >= 0 AND distance <= 100)
{body}"""


_FILTERED = "SELECT ship_name, speed, category AS status_category, round(distance, 6) AS distance_to_port_km FROM filtered"


def _alerts_cte(source: str, high: float, near: float, close: float) -> str:
    return f"""
, ruled AS (
  SELECT *, CASE
      WHEN speed >= {high} AND distance <= {near} THEN 'speeding_near_port'
      WHEN NOT in_port AND distance <= {close} AND speed < 0.2 THEN 'stopped_near_port'
      WHEN NOT in_port AND distance <= {close} THEN 'approaching_port' END AS type
  FROM {source}),
alerts AS (
  SELECT *, CASE type WHEN 'speeding_near_port' THEN 'high' WHEN 'stopped_near_port' THEN 'medium'
                      ELSE 'low' END AS priority,
         CASE type WHEN 'speeding_near_port' THEN 0 WHEN 'stopped_near_port' THEN 1 ELSE 2 END AS priority_rank
  FROM ruled WHERE type IS NOT NULL)"""


_WIDE = _alerts_cte("filtered", 5, 8, 8)
_ALERTS = """
SELECT ship_name AS ship, priority, priority_rank, type, speed, round(distance, 6) AS distance,
       time_display AS time
FROM alerts"""

_EVERY_POSITION = f"""
, every AS (SELECT *, {_DISTANCE} AS distance, strftime(timestamp, '%H:%M:%S') AS time_display FROM silver)
{_alerts_cte("every", 5, 8, 8)}"""
_KEY = "concat_ws('|', priority, ship_name, type, time_display)"


def _timeline(where: str, minutes: int) -> str:
    return f"""
, binned AS (SELECT *, time_bucket(INTERVAL '{minutes} minutes', timestamp) AS ts_bin FROM silver {where})
SELECT ts_bin, count(DISTINCT ship_name) AS vessels_total,
       count(*) FILTER (in_port) AS rows_in_port,
       count(*) FILTER (NOT in_port AND speed > 0.5) AS rows_moving,
       count(*) FILTER (NOT in_port AND speed <= 0.5) AS rows_stopped
FROM binned GROUP BY ts_bin"""


def _trailing(hours: int) -> str:
    return f"WHERE timestamp >= (SELECT t FROM newest) - INTERVAL '{hours} hours'"


# Five-minute buckets that begin within 48 hours of the newest one's beginning.
_LAST_48H = """
, binned AS (SELECT *, time_bucket(INTERVAL '5 minutes', timestamp) AS ts_bin FROM silver)
SELECT count(DISTINCT ship_name) AS vessels_total,
       CAST(count(*) FILTER (in_port) AS BIGINT) AS rows_in_port,
       CAST(count(*) FILTER (NOT in_port AND speed > 0.5) AS BIGINT) AS rows_moving,
       CAST(count(*) FILTER (NOT in_port AND speed <= 0.5) AS BIGINT) AS rows_stopped
FROM binned WHERE ts_bin >= (SELECT max(ts_bin) FROM binned) - INTERVAL '48 hours'"""

_KPIS = """
SELECT count(*) AS vessels,
       CAST(sum(CASE WHEN category = 'moving' THEN 1 ELSE 0 END) AS BIGINT) AS moving,
       CAST(sum(CASE WHEN category = 'port' THEN 1 ELSE 0 END) AS BIGINT) AS in_port,
       CAST(sum(CASE WHEN category = 'stopped' THEN 1 ELSE 0 END) AS BIGINT) AS stopped,
       round(coalesce(avg(speed), 0.0), 6) AS avg_speed,
       max(speed) AS max_speed,
       CAST(sum(CASE WHEN score = 100 THEN 1 ELSE 0 END) AS BIGINT) AS fresh,
       round(100.0 * sum(CASE WHEN score = 100 THEN 1 ELSE 0 END) / count(*), 6) AS fresh_pct
FROM fleet"""

_COLOUR = """CASE category WHEN 'moving' THEN '16,185,129,190' WHEN 'stopped' THEN '239,68,68,190'
              WHEN 'port' THEN '59,130,246,200' END"""
_SIZE = "round(least(1200.0, greatest(280.0, coalesce(speed, 0) * 220)), 6)"

_RAW = """
, raw AS (
  SELECT p.*, e.event_type, CASE WHEN p.event_id % 97 = 0 THEN 91 ELSE p.lat END AS raw_lat
  FROM positions p JOIN events e ON p.event_id = e.event_id),
outcome AS (
  SELECT *, CASE WHEN event_type = 'purchase' THEN 'other_kind'
                 WHEN raw_lat IS NULL OR lon IS NULL THEN 'missing_field'
                 WHEN raw_lat > 90 OR lon > 180 THEN 'position_unavailable' ELSE 'ok' END AS outcome
  FROM raw),
normal AS (
  SELECT event_id, mmsi, ship_name, raw_lat AS lat, lon, coalesce(speed, 0.0) AS speed,
         CASE WHEN event_type = 'click' AND heading = 511
              THEN CAST(event_id % 360 AS DOUBLE) ELSE heading END AS heading,
         CASE event_type WHEN 'click' THEN 'Class B Active' WHEN 'view' THEN 'Under way'
              ELSE 'Moored/Anchored' END AS status, timestamp
  FROM outcome WHERE outcome = 'ok')"""

_RULES = {
    "mmsi_missing": "mmsi IS NULL",
    "ship_name_missing": "ship_name IS NULL",
    "lat_missing": "lat IS NULL",
    "lon_missing": "lon IS NULL",
    "speed_missing": "speed IS NULL",
    "heading_missing": "heading IS NULL",
    "mmsi_digits": "length(CAST(mmsi AS VARCHAR)) <> 9",
    "mmsi_range": "mmsi < 100000000 OR mmsi > 999999999",
    "lat_range": "lat < -90 OR lat > 90",
    "lon_range": "lon < -180 OR lon > 180",
    "speed_negative": "speed < 0",
    "speed_limit": "speed > 102.2",
    "heading_range": "heading < 0 OR heading > 360",
    "timestamp_missing": "timestamp IS NULL",
}
_BROKEN = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _RULES.items()) + ")"

_STEPS = """
, steps AS (
  SELECT ship_name, timestamp, in_port,
         lag(in_port) OVER (PARTITION BY ship_name ORDER BY timestamp, event_id) AS before
  FROM silver)"""
_TRANSITIONS = _STEPS + """
SELECT ship_name, timestamp, CASE WHEN in_port THEN 'entry' ELSE 'exit' END AS event
FROM steps WHERE in_port <> before"""

_OPERATIONAL = """
SELECT ship_name, speed, heading, category AS status_category,
       round(distance, 6) AS distance_to_port_km, age_sec, time_display
FROM filtered ORDER BY category, speed DESC NULLS LAST, ship_name LIMIT 120"""


def _stalest(key: str) -> str:
    return f"""
SELECT {key}, age_sec, time_display, category AS status_category, round(distance, 6) AS distance_to_port_km
FROM fleet ORDER BY age_sec DESC, {key} LIMIT 25"""


_FIELDS = ("mmsi", "ship_name", "lat", "lon", "speed", "heading", "status", "timestamp")
_CHECKED = _RULES | {"position_zero": "lat = 0 OR lon = 0"}
_QUARANTINE = (
    """, fed AS (SELECT event_id, """
    + ", ".join(
        f"CASE WHEN event_id % 211 = 0 THEN NULL"
        + (" WHEN event_id % 223 = 0 THEN NULL" if c == "mmsi" else "")
        + (" WHEN event_id % 223 <> 0 AND event_id % 227 = 0 AND lat IS NOT NULL THEN 'NaN'::DOUBLE" if c == "lat" else "")
        + f" ELSE {c} END AS {c}"
        for c in _FIELDS
    )
    + """ FROM positions),
broken AS ("""
    + " UNION ALL ".join(f"SELECT event_id, '{name}' AS rule FROM fed WHERE {test}" for name, test in _CHECKED.items())
    + """)
SELECT rule AS outcome, count(*) AS records FROM broken GROUP BY 1
UNION ALL SELECT 'set aside', count(DISTINCT event_id) FROM broken
UNION ALL SELECT 'kept', count(*) FROM fed WHERE event_id NOT IN (SELECT event_id FROM broken)"""
)

_LATEST_CORE = "ship_name, lat, lon, speed, in_port, timestamp, event_id"
_DAY, _SIX_HOURS = 86400, 21600

# Each shape by its own inequalities: half-planes, a box, a norm, two boxes.
_ZONES = """, zones AS (SELECT CAST(n_nationkey AS DOUBLE) AS k, n_nationkey % 4 AS kind, n_name AS port FROM nation)
SELECT event_id, port FROM silver LEFT JOIN zones ON CASE kind
  WHEN 0 THEN lat >= -20.00041
          AND (lat + 20.00041) * (-15.45037 + 0.005 * k + 60.00037) <= (lon + 60.00037) * (28.20041 + 0.003 * k + 20.00041)
          AND (lat + 20.00041) * (-15.45037 + 0.005 * k - 40.00037) >= (lon - 40.00037) * (28.20041 + 0.003 * k + 20.00041)
  WHEN 1 THEN lat BETWEEN -59.9995 AND 28.1505 AND lon BETWEEN -99.9995 AND -15.4005 + 0.002 * k
  WHEN 2 THEN abs(lon + 15.40037) * 0.0041 + abs(lat - 28.15041) * 0.0053 <= 0.0041 * 0.0053 * k
  ELSE lon >= -15.4805 + 0.002 * k AND lat >= 28.0705
       AND ((lon <= -15.3605 + 0.002 * k AND lat <= 28.1305) OR (lon <= -15.4205 + 0.002 * k AND lat <= 28.2205)) END"""


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    chord = f"least(1, pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    return f"2 * 6371.0 * atan2(sqrt({chord}), sqrt(1 - {chord}))"


_NEAREST = f"""
WITH positions AS (SELECT event_id, {", ".join(f"{e} AS {c}" for c, e in WORLD_POSITION.items())} FROM events),
ports AS (SELECT {", ".join(f"{e} AS {c}" for c, e in WORLD_PORT.items())} FROM supplier),
pairs AS (SELECT event_id, port, {_km("p.lat", "p.lon", "q.lat", "q.lon")} AS km FROM positions p CROSS JOIN ports q WHERE p.lat IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY km, port) AS port_rank FROM pairs)
SELECT p.event_id, r.port, coalesce(CAST(r.port_rank AS INTEGER), 0) AS port_rank, round(r.km, 3) AS port_km
FROM positions p LEFT JOIN (SELECT * FROM ranked WHERE port_rank <= 3) r ON p.event_id = r.event_id"""

_IN_REACH = f"""
, spots AS (
  SELECT n_name AS port, ((28050 + (n_nationkey % 5) * 40) / 1000.0::DOUBLE + (28080 + (n_nationkey % 5) * 40) / 1000.0::DOUBLE) / 2 + 0.00037 AS plat,
         ((-15500 + (n_nationkey // 5) * 40) / 1000.0::DOUBLE + (-15470 + (n_nationkey // 5) * 40) / 1000.0::DOUBLE) / 2 + 0.00071 AS plon
  FROM nation),
closest AS (
  SELECT event_id, arg_min(port, km) AS port, min(km) AS km
  FROM (SELECT event_id, port, {_km("lat", "lon", "plat", "plon")} AS km FROM silver CROSS JOIN spots) GROUP BY event_id)
SELECT event_id, CASE WHEN km <= 5 THEN port END AS port FROM closest"""

_STAYS = """
, changes AS (SELECT * FROM steps WHERE in_port <> before OR (before IS NULL AND in_port)),
stays AS (
  SELECT ship_name, timestamp AS entered_at, in_port, before IS NOT NULL AS entry_seen,
         lead(timestamp) OVER (PARTITION BY ship_name ORDER BY timestamp) AS left_at
  FROM changes)
SELECT ship_name, entered_at, left_at, entry_seen,
       (epoch_us(left_at) - epoch_us(entered_at)) / 1e6 AS dwell_sec
FROM stays WHERE in_port"""

_SILENCES = """
, following AS (
  SELECT ship_name, timestamp, lead(timestamp) OVER (PARTITION BY ship_name ORDER BY timestamp) AS resumed_at
  FROM (SELECT DISTINCT ship_name, timestamp FROM silver))
SELECT ship_name, timestamp AS silent_since, resumed_at
FROM following WHERE coalesce(resumed_at, (SELECT t FROM newest)) > timestamp + INTERVAL '12 hours'"""

# The last report is that of the second event's vessel, a day after the newest one.
_SILENCE_NOTICES = """
, closing AS (SELECT (SELECT max(ts) FROM events) + INTERVAL '1 day' AS t),
every_report AS (
  SELECT ship_name, timestamp FROM silver
  UNION SELECT ship_name, (SELECT t FROM closing) FROM silver WHERE event_id = (SELECT min(event_id) + 1 FROM events)),
following AS (
  SELECT ship_name, timestamp, lead(timestamp) OVER (PARTITION BY ship_name ORDER BY timestamp) AS resumed_at FROM every_report)
SELECT ship_name, timestamp AS silent_since, timestamp + INTERVAL '12 hours' AS due_at
FROM following
WHERE (resumed_at IS NULL OR resumed_at > timestamp + INTERVAL '12 hours')
  AND (SELECT t FROM closing) - INTERVAL '1 hour' > timestamp + INTERVAL '12 hours'"""

_DRIFT = """
SELECT field, count(*) AS records FROM (
  SELECT unnest(['draught', 'dest', 'dest.port']) AS field FROM silver WHERE event_id % 7 = 0
  UNION ALL SELECT 'speed' FROM silver WHERE event_id % 11 = 0 AND speed IS NOT NULL)
GROUP BY field"""

_AS_OF_HALF = """
, half AS (
  SELECT * FROM silver WHERE event_id < (SELECT min(event_id) + (max(event_id) + 1 - min(event_id)) * 2 // 4 FROM events)),
newest_of AS (SELECT *, row_number() OVER (PARTITION BY ship_name ORDER BY timestamp DESC NULLS LAST, event_id DESC) AS place FROM half)
SELECT ship_name, lat, lon, speed, in_port, timestamp, event_id FROM newest_of WHERE place = 1"""

ORACLES: dict[str, str] = {
    "clean_positions": _with(
        "SELECT event_id, mmsi, ship_name, lat, lon, speed, heading, status, timestamp FROM silver"
    ),
    "bbox_positions": _with(
        "SELECT * FROM positions WHERE lat BETWEEN 27.0 AND 29.5 AND lon BETWEEN -18.5 AND -13.0"
    ),
    "bbox_inner": _with(
        "SELECT * FROM positions WHERE lat >= 28.1 AND lat <= 28.2 AND lon >= -15.45 AND lon <= -15.35"
    ),
    "geofence_concave": _with(
        """SELECT event_id, (lat > 28.0705 AND lat < 28.1305 AND lon > -15.4805 AND lon < -15.3605)
                        OR (lat > 28.0705 AND lat < 28.2205 AND lon > -15.4805 AND lon < -15.4205) AS in_port
FROM silver"""
    ),
    "geofence_flag": _with("SELECT event_id, in_port FROM silver"),
    "geofence_polygon": _with("SELECT event_id, in_port FROM silver"),
    "zone_assignment": _with(_ZONES),
    "nearest_ports": _NEAREST,
    "nearest_port_in_reach": _with(_IN_REACH),
    "lake_box": _with(
        """SELECT mmsi, ship_name, lat, lon, speed, heading, status, timestamp, in_port,
       strftime(timestamp, '%Y-%m-%d') AS date
FROM silver WHERE lat >= 28.1 AND lat <= 28.2 AND lon >= -15.45 AND lon <= -15.35"""
    ),
    "port_assignment": _with(
        """, boxes AS (
  SELECT n_name AS port, (28050 + (n_nationkey % 5) * 40) / 1000.0::DOUBLE AS lat_min,
         (28080 + (n_nationkey % 5) * 40) / 1000.0::DOUBLE AS lat_max,
         (-15500 + (n_nationkey // 5) * 40) / 1000.0::DOUBLE AS lon_min,
         (-15470 + (n_nationkey // 5) * 40) / 1000.0::DOUBLE AS lon_max
  FROM nation)
SELECT event_id, port FROM silver LEFT JOIN boxes
  ON lat >= lat_min AND lat <= lat_max AND lon >= lon_min AND lon <= lon_max"""
    ),
    "normalize_ais": _with(_RAW + " SELECT * FROM normal"),
    "ingest_outcomes": _with(_RAW + " SELECT outcome, count(*) AS messages FROM outcome GROUP BY 1"),
    "ingest_outcomes_malformed": _with(
        _RAW
        + """ SELECT CASE WHEN event_id % 211 = 0 THEN 'malformed' ELSE outcome END AS outcome,
       count(*) AS messages FROM outcome GROUP BY 1"""
    ),
    "normalize_area": _with(
        _RAW + " SELECT * FROM normal WHERE lat >= 28.1 AND lat <= 28.2 AND lon >= -15.45 AND lon <= -15.35"
    ),
    "nav_status_counts": _with(_RAW + " SELECT status, count(*) AS messages FROM normal GROUP BY 1"),
    "json_roundtrip": _with(
        "SELECT mmsi, ship_name, lat, lon, speed, heading, status, timestamp FROM positions"
    ),
    "latest_vessels": _with(
        """SELECT ship_name, lat, lon, speed, heading, status, in_port, timestamp,
       round(distance, 6) AS distance_to_port_km, category AS status_category FROM fleet"""
    ),
    "latest_by_mmsi": _with(
        "SELECT mmsi, ship_name, lat, lon, speed, in_port, timestamp, event_id FROM latest", key="mmsi"
    ),
    "latest_vessels_sql": _with(
        "SELECT ship_name, lat, lon, speed, heading, status, in_port, timestamp, CAST(rn AS INTEGER) AS rn FROM latest"
    ),
    "latest_as_of": _with(
        """, arrived AS (
  SELECT *, timestamp + to_minutes(event_id % 7) AS ingestion_time FROM silver),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ship_name ORDER BY timestamp DESC, event_id DESC) AS place
  FROM arrived WHERE ingestion_time <= (SELECT t FROM newest) - INTERVAL '24 hours')
SELECT ship_name, lat, lon, timestamp, ingestion_time, event_id FROM ranked WHERE place = 1"""
    ),
    "upsert_latest": _with(f"SELECT {_LATEST_CORE} FROM latest"),
    "enriched_fleet": _with(
        f"""SELECT ship_name, lat, lon, speed, heading, status, in_port, timestamp, time_display,
       round(distance, 6) AS distance_to_port_km, category AS status_category, age_sec,
       score AS quality_score, {_COLOUR} AS color, {_SIZE} AS size FROM fleet""",
        _SIX_HOURS,
        _DAY,
    ),
    "fleet_filtered": _with(
        _FILTERED + " WHERE category IN ('moving', 'stopped') AND speed >= 1.0 AND distance <= 9.0"
    ),
    "vessel_search": _with(_FILTERED + " WHERE regexp_matches(ship_name, 'sel 0+[1-4]', 'i')"),
    "vessel_search_literal": _with(_FILTERED + " WHERE contains(lower(ship_name), 'vessel 00')"),
    "name_search_indexed": _with("SELECT event_id, ship_name FROM silver WHERE regexp_matches(ship_name, 'sel 0+[1-4]', 'i')"),
    "name_search_indexed_literal": _with("SELECT event_id, ship_name FROM silver WHERE contains(lower(ship_name), 'vessel 00')"),
    "zone_inside": _with(_FILTERED + " WHERE in_port"),
    "zone_outside": _with(_FILTERED + " WHERE NOT in_port"),
    "quality_filter": _with(_FILTERED + " WHERE score >= 60", _SIX_HOURS, _DAY),
    "operational_table": _with(_OPERATIONAL),
    "top_speed": _with(
        """SELECT ship_name, speed, round(distance, 6) AS distance_to_port_km, category AS status_category
FROM filtered ORDER BY speed DESC NULLS LAST, ship_name LIMIT 10"""
    ),
    "stalest_vessels": _with(_stalest("ship_name")),
    "worst_offenders": _with(_stalest("mmsi"), key="mmsi"),
    "fleet_kpis": _with(_KPIS),
    "fleet_kpis_hourly": _with(_KPIS, _SIX_HOURS, _DAY),
    "fleet_kpis_catalog": _with(
        """SELECT count(DISTINCT ship_name) AS total_vessels,
       CAST(sum(CASE WHEN in_port THEN 1 END) AS BIGINT) AS in_port,
       count(*) FILTER (WHERE speed > 0.5) AS moving,
       round(avg(speed), 6) AS avg_speed,
       round(100.0 * count(*) FILTER (WHERE score = 100) / count(*), 6) AS data_quality
FROM fleet""",
        _SIX_HOURS,
        _DAY,
    ),
    "status_counts": _with(
        """SELECT category AS status_category, count(*) AS vessels,
       CASE category WHEN 'moving' THEN 'En movimiento' WHEN 'stopped' THEN 'Parado/Fondeado'
                     WHEN 'port' THEN 'En puerto' END AS label
FROM filtered GROUP BY category"""
    ),
    "speed_histogram": _with(
        """, span AS (SELECT min(speed) AS lo, max(speed) AS hi, (max(speed) - min(speed)) / 18 AS w FROM filtered),
binned AS (
  SELECT CAST(least(floor((speed - lo) / w) + 1, 18) AS INTEGER) AS bin, count(*) AS vessels
  FROM filtered, span GROUP BY 1)
SELECT bin, round(lo + (bin - 1) * w, 6) AS bin_from, round(lo + bin * w, 6) AS bin_to, vessels
FROM binned, span"""
    ),
    "speed_vs_distance": _with(
        "SELECT ship_name, round(distance, 6) AS distance_to_port_km, speed FROM filtered"
    ),
    "freshness_bands": _with(
        """SELECT CASE score WHEN 100 THEN 'fresh' WHEN 60 THEN 'warning' ELSE 'stale' END AS band,
       count(*) AS vessels FROM fleet GROUP BY 1""",
        _SIX_HOURS,
        _DAY,
    ),
    "traffic_timeline": _with(_timeline(_trailing(24), 10)),
    "traffic_timeline_5m": _with(_timeline(_trailing(48), 5)),
    "traffic_timeline_15m": _with(_timeline(_trailing(24), 15)),
    "traffic_timeline_30m": _with(_timeline(_trailing(6), 30)),
    "traffic_history": _with(_timeline("", 10)),
    "alerts_default": _with(_alerts_cte("filtered", 10, 5, 3) + _ALERTS),
    "alerts_wide": _with(_WIDE + _ALERTS),
    "alert_messages": _with(
        _WIDE
        + """
SELECT ship_name AS ship, CASE priority
    WHEN 'high' THEN printf('%s navega a %.1f kn a %.1f km del puerto.', ship_name, speed, distance)
    WHEN 'medium' THEN printf('%s está parado a %.1f km del puerto (fuera de geofence).', ship_name, distance)
    ELSE printf('%s se aproxima (distancia: %.1f km).', ship_name, distance) END AS message
FROM alerts"""
    ),
    "alert_kpis": _with(
        _WIDE
        + " SELECT count(*) AS active_alerts, count(*) FILTER (WHERE priority = 'high') AS critical_alerts FROM alerts"
    ),
    "stale_alerts": _with(
        """SELECT ship_name AS ship, 'low' AS priority, 'stale_position' AS type, age_sec, time_display AS time
FROM fleet WHERE score = 20""",
        _SIX_HOURS,
        _DAY,
    ),
    "alerting_vessels": _with(
        _WIDE + " " + _FILTERED + " WHERE ship_name IN (SELECT ship_name FROM alerts)"
    ),
    "quiet_vessels": _with(
        _WIDE + " " + _FILTERED + " WHERE ship_name NOT IN (SELECT ship_name FROM alerts)"
    ),
    "map_layers": _with(
        _WIDE
        + f"""
SELECT ship_name, lat, lon, CASE WHEN type IS NULL THEN 'normal' ELSE 'alert' END AS layer,
       CASE WHEN type IS NULL THEN {_COLOUR} ELSE '245,158,11,220' END AS color,
       CASE WHEN type IS NULL THEN {_SIZE} ELSE 900.0 END AS radius
FROM ruled"""
    ),
    "alert_dedup": _with(
        _EVERY_POSITION
        + f"""
SELECT priority, ship_name AS ship, type, time_display AS time, count(*) AS raised, {_KEY} AS alert_key
FROM alerts WHERE priority = 'high' GROUP BY priority, ship_name, type, time_display"""
    ),
    "alert_dedup_repeated": _with(
        _EVERY_POSITION
        + f"""
SELECT priority, ship_name AS ship, type, time_display AS time,
       CAST(sum(CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS raised, {_KEY} AS alert_key
FROM alerts WHERE priority = 'high' GROUP BY priority, ship_name, type, time_display"""
    ),
    "contract_violations": _with(
        ", counted AS ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS rule, count(*) AS records FROM positions WHERE {c}" for n, c in _RULES.items()
        )
        + ") SELECT * FROM counted WHERE records > 0"
    ),
    "valid_positions": _with(f"SELECT * FROM positions WHERE {_BROKEN} = ''"),
    "quarantine": _with(f"SELECT event_id, {_BROKEN} AS violations FROM positions WHERE {_BROKEN} <> ''"),
    "port_transitions": _with(_TRANSITIONS),
    "port_visits": _with(_STEPS + _STAYS),
    "rows_by_date": _with(
        "SELECT strftime(timestamp, '%Y-%m-%d') AS date, count(*) AS positions FROM silver GROUP BY 1"
    ),
    "lake_mixed_writers": _with(
        """SELECT mmsi, ship_name, lat, lon, speed, heading, status, timestamp, in_port,
       strftime(timestamp, '%Y-%m-%d') AS date FROM silver"""
    ),
    "stream_quarantine": _with(_QUARANTINE),
    **{f"traffic_rollup_{m}m": _with(_timeline("", m)) for m in (5, 10, 15, 30)},
    "traffic_rollup_48h": _with(_LAST_48H),
    "stream_rollup": _with(_timeline("", 10)),
    "lake_timeline": _with(_timeline(_trailing(24), 10)),
    "csv_export_roundtrip": _with(_OPERATIONAL),
    "stream_etl": _with(
        """SELECT mmsi, ship_name, lat, lon, speed, heading, status, timestamp, in_port,
       strftime(timestamp, '%Y-%m-%d') AS date FROM silver"""
    ),
    "stream_timeline": _with(_timeline("", 10)),
    "silences": _with(_SILENCES),
    "stream_silences": _with(_SILENCE_NOTICES),
    "lake_drift": _with(_DRIFT),
    "stream_transitions": _with(_TRANSITIONS),
    "stream_transitions_late": _with(_TRANSITIONS),
    "stream_visits": _with(_STEPS + _STAYS),
    "snapshot_as_of_version": _with(_AS_OF_HALF),
    "stream_latest": _with(f"SELECT {_LATEST_CORE} FROM latest"),
    "stream_alert_dedup": _with(
        _EVERY_POSITION
        + f"""
SELECT DISTINCT priority, ship_name AS ship, type, time_display AS time, {_KEY} AS alert_key
FROM alerts WHERE priority = 'high'"""
    ),
    "stream_alert_notices": _with(
        _EVERY_POSITION
        + f"""
SELECT DISTINCT priority, ship_name AS ship, type, time_display AS time, {_KEY} AS alert_key
FROM alerts WHERE priority = 'high'"""
    ),
}
