"""Positions and raw AIS messages derived from an ``events`` table.

``events``: event_id, ts, user_id, event_type, value, props. Every row becomes
one position; some get missing, zero, out-of-range or odd values on purpose.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.config import Settings
from wakeline.operators.clean import to_silver
from wakeline.operators.normalize import CLASS_A, CLASS_B

EVENTS = (
    "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
#: Rows of a file that is landed for a stream, about.
FILE_ROWS = 250_000

# Valid in Spark SQL and in other ANSI engines alike, so that a check can reuse them.
POSITION_EXPRESSIONS = {
    "event_id": "event_id",
    "mmsi": "CAST(CASE WHEN event_id % 103 = 0 THEN 1000 + user_id ELSE 224000000 + user_id END AS INTEGER)",
    "ship_name": "concat('VESSEL ', lpad(CAST(user_id AS STRING), 4, '0'))",
    "lat": "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN CAST(0 AS DOUBLE) "
    "ELSE CAST(28050 + (event_id * 37) % 201 AS DOUBLE) / CAST(1000 AS DOUBLE) END",
    "lon": "CASE WHEN event_id % 101 = 0 THEN NULL "
    "ELSE CAST(-15500 + (event_id * 53) % 199 AS DOUBLE) / CAST(1000 AS DOUBLE) END",
    "speed": "CASE WHEN event_id % 109 = 0 THEN NULL WHEN event_id % 113 = 0 THEN CAST(-1 AS DOUBLE) "
    "WHEN event_id % 107 = 0 THEN CAST(1030 + event_id % 50 AS DOUBLE) / CAST(10 AS DOUBLE) "
    "WHEN event_id % 5 = 0 THEN value / CAST(1000 AS DOUBLE) ELSE value / CAST(10 AS DOUBLE) END",
    "heading": "CASE WHEN event_id % 83 = 0 THEN CAST(511 AS DOUBLE) "
    "ELSE CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) * CAST(3.7 AS DOUBLE) END",
    "status": "CASE event_type WHEN 'click' THEN 'Class B Active' WHEN 'view' THEN 'Under way' "
    "ELSE 'Moored/Anchored' END",
    "timestamp": "ts",
}


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(events_path(sf_dir))


def stream_events(
    spark: SparkSession, sf_dir: str, folder: str, parts: int = 4, again: bool = False, closing: bool = False, shuffled: bool = False,
    file_rows: int = FILE_ROWS,
) -> DataFrame:
    """All events as a stream of ``parts`` micro-batches, in order of ``event_id``.

    They are landed in ``folder`` in that many steps, of which each is a micro-batch: all steps have the same
    number of files, set by the size of the table, and a trigger takes that many. ``again`` lands the first part
    once more at the end, late and repeated; ``closing`` adds one event a day after
    the newest, so that every window before it closes. ``shuffled`` deals events out regardless of
    their time, so that most of them arrive late.
    """
    events = read_events(spark, sf_dir)
    low, high, newest, rows = events.agg(F.min("event_id"), F.max("event_id"), F.max("ts"), F.count("*")).first()
    files = max(1, ceil(rows / parts / file_rows))
    bounds = [low + (high + 1 - low) * i // parts for i in range(parts + 1)]
    steps = [events.filter((F.col("event_id") >= a) & (F.col("event_id") < b)) for a, b in zip(bounds, bounds[1:], strict=False)]
    if shuffled:
        steps = [events.filter(F.pmod(F.xxhash64("event_id"), F.lit(parts)) == i) for i in range(parts)]
    if again:
        steps.append(steps[0])
    if closing:
        steps.append(events.filter(F.col("event_id") == low + 1).withColumn("ts", F.lit(newest) + F.make_dt_interval(days=F.lit(1))))
    for step in steps:
        step.repartition(files).write.mode("append").parquet(folder)
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(folder)


def as_positions(events: DataFrame) -> DataFrame:
    return events.select(*[F.expr(e).alias(c) for c, e in POSITION_EXPRESSIONS.items()])


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_positions(read_events(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str, settings: Settings | None = None) -> DataFrame:
    rows = positions(spark, sf_dir)
    return to_silver(rows, settings) if settings else to_silver(rows)


def as_raw_ais(events: DataFrame) -> DataFrame:
    """``event_id, timestamp, value``: one raw JSON message per event.

    Class B for clicks, a kind nobody uses for purchases, Class A otherwise.
    Null fields are left out of the JSON.
    """
    rows = events.select(
        "event_type", *[F.expr(e).alias(c) for c, e in POSITION_EXPRESSIONS.items()]
    )
    kind = F.col("event_type")
    event_id = F.col("event_id")
    unavailable = event_id % 83 == 0
    common: list[Column] = [
        F.col("mmsi").alias("UserID"),
        F.when(event_id % 97 == 0, 91.0).otherwise(F.col("lat")).alias("Latitude"),
        F.col("lon").alias("Longitude"),
        F.col("speed").alias("Sog"),
        F.when(unavailable, 511.0).otherwise(F.col("heading")).alias("TrueHeading"),
    ]
    class_a = F.struct(*common, F.when(kind == "view", 0).otherwise(5).alias("NavigationalStatus"))
    class_b = F.struct(*common, F.when(unavailable, (event_id % 360).cast("double")).alias("Cog"))
    is_a = kind.isin("view", "signup", "error")
    message = F.struct(
        F.when(kind == "click", CLASS_B)
        .when(kind == "purchase", "ShipStaticData")
        .otherwise(CLASS_A)
        .alias("MessageType"),
        F.struct(F.concat("ship_name", F.lit("  ")).alias("ShipName")).alias("MetaData"),
        F.struct(
            F.when(is_a, class_a).alias(CLASS_A), F.when(kind == "click", class_b).alias(CLASS_B)
        ).alias("Message"),
    )
    return rows.select("event_id", "timestamp", F.to_json(message).alias("value"))


def raw_ais(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw_ais(read_events(spark, sf_dir))


def faulty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions as JSON text; some are no JSON, overflow or are not a number."""
    value, event_id = F.col("value"), F.col("event_id")
    record = F.to_json(F.struct(*schemas.POSITION_COLUMNS), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    faulty = (
        F.when(event_id % 211 == 0, "not json")
        .when(event_id % 223 == 0, F.regexp_replace(value, r'"mmsi":\d+', '"mmsi":99999999999'))
        .when(event_id % 227 == 0, F.regexp_replace(value, r'"lat":[-0-9.]+', '"lat":NaN'))
        .otherwise(value)
    )
    return positions(spark, sf_dir).select("event_id", record.alias("value")).select(faulty.alias("value"))


def drifted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions as JSON text of a feed that has changed: new fields, one of them an object, and speeds in words."""
    value, event_id = F.col("value"), F.col("event_id")
    record = F.to_json(F.struct(*schemas.POSITION_COLUMNS), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    worded = F.when(event_id % 11 == 0, F.regexp_replace(value, r'"speed":[-0-9.E]+', '"speed":"fast"')).otherwise(value)
    more = F.when(event_id % 7 == 0, F.regexp_replace(worded, r"}$", ',"draught":4.5,"dest":{"port":"LPA"},"note":null}')).otherwise(worded)
    return positions(spark, sf_dir).select("event_id", record.alias("value")).select(more.alias("value"))


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One port box per row of ``nation``, laid out on a 5-wide grid without overlaps."""
    key = F.col("n_nationkey")
    south, west = F.lit(28050) + (key % 5) * 40, F.lit(-15500) + F.floor(key / 5) * 40
    return (
        spark.read.schema("n_nationkey INT, n_name STRING")
        .parquet(f"{sf_dir.rstrip('/')}/nation.parquet")
        .select(
            F.col("n_name").alias("port"),
            (south / F.lit(1000.0)).alias("lat_min"),
            ((south + 30) / F.lit(1000.0)).alias("lat_max"),
            (west / F.lit(1000.0)).alias("lon_min"),
            ((west + 30) / F.lit(1000.0)).alias("lon_max"),
        )
    )


# Corners of the zones below, in SQL of the key ``k`` of a row of ``nation``: triangles across an ocean,
# boxes across an ocean, diamonds around one spot, each in the next, and angles.
ZONE_CORNERS = {
    0: (("-60.00037", "-20.00041"), ("40.00037", "-20.00041"), ("-15.45037 + 0.005 * k", "28.20041 + 0.003 * k")),
    1: (("-99.9995", "-59.9995"), ("-15.4005 + 0.002 * k", "-59.9995"), ("-15.4005 + 0.002 * k", "28.1505"), ("-99.9995", "28.1505")),
    2: (("-15.40037 - 0.0053 * k", "28.15041"), ("-15.40037", "28.15041 - 0.0041 * k"), ("-15.40037 + 0.0053 * k", "28.15041"), ("-15.40037", "28.15041 + 0.0041 * k")),
    3: (
        ("-15.4805 + 0.002 * k", "28.0705"), ("-15.3605 + 0.002 * k", "28.0705"), ("-15.3605 + 0.002 * k", "28.1305"),
        ("-15.4205 + 0.002 * k", "28.1305"), ("-15.4205 + 0.002 * k", "28.2205"), ("-15.4805 + 0.002 * k", "28.2205"),
    ),
}


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One polygon per row of ``nation``, from a few cables to an ocean, many in one another."""
    nations = spark.read.schema("n_nationkey INT, n_name STRING").parquet(f"{sf_dir.rstrip('/')}/nation.parquet")
    corners = {kind: ", ".join(f"struct(double({x}) AS lon, double({y}) AS lat)" for x, y in own) for kind, own in ZONE_CORNERS.items()}
    polygon = F.expr("CASE k % 4 " + " ".join(f"WHEN {kind} THEN array({own})" for kind, own in corners.items()) + " END")
    shaped = nations.select(F.col("n_name").alias("port"), F.col("n_nationkey").alias("k")).withColumn("polygon", polygon)
    ends = {f"{axis}_{end}": pick(F.col(f"polygon.{axis}")) for axis in ("lat", "lon") for end, pick in (("min", F.array_min), ("max", F.array_max))}
    return shaped.withColumns(ends).drop("k")


# Positions and ports all over the globe, poles and date line included; some ports share a spot.
WORLD_POSITION = {
    "lat": "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST((event_id * 7907) % 18001 - 9000 AS DOUBLE) / CAST(100 AS DOUBLE) END",
    "lon": "CAST((event_id * 104729) % 36001 - 18000 AS DOUBLE) / CAST(100 AS DOUBLE)",
}
WORLD_PORT = {
    "port": "concat('PORT ', CAST(s_suppkey AS STRING))",
    "lat": "CASE WHEN s_suppkey % 3 = 0 THEN CAST(28.00137 AS DOUBLE) + CAST(s_suppkey % 89 AS DOUBLE) / CAST(700 AS DOUBLE) "
    "ELSE CAST(((s_suppkey - s_suppkey % 2) * 7919) % 17903 - 8951 AS DOUBLE) / CAST(100.03 AS DOUBLE) END",
    "lon": "CASE WHEN s_suppkey % 3 = 0 THEN CAST(-15.40213 AS DOUBLE) + CAST(s_suppkey % 83 AS DOUBLE) / CAST(900 AS DOUBLE) "
    "ELSE CAST(((s_suppkey - s_suppkey % 2) * 104729) % 35993 - 17996 AS DOUBLE) / CAST(100.07 AS DOUBLE) END",
}


def world_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, sf_dir).select("event_id", *[F.expr(e).alias(c) for c, e in WORLD_POSITION.items()])


def world_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = spark.read.parquet(f"{sf_dir.rstrip('/')}/supplier.parquet")
    return suppliers.select(*[F.expr(e).alias(c) for c, e in WORLD_PORT.items()])
