"""Position filters and the silver-level transformation shared by batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.config import DEFAULTS, Rectangle, Settings
from wakeline.functions.geo import in_polygon, in_rectangle
from wakeline.functions.times import parse_utc
from wakeline.functions.vessel import not_nan
from wakeline.operators.once import evaluate_once

MEASURES = ("lat", "lon", "speed", "heading")


def parse_events(records: DataFrame, keep_text: bool = False) -> DataFrame:
    """Flat JSON records in ``value`` (text or bytes) to typed positions.

    Garbage gives a row of nulls and a wrongly typed or overflowing field a null
    field; the coordinate filter removes what is unusable. ``keep_text`` carries
    ``value`` along as text.
    """
    text = records.select(F.col("value").cast("string").alias("value"))
    event = F.from_json(F.col("value"), schemas.WIRE_EVENT)
    flat = evaluate_once(text, event, "event").select("event.*", *(["value"] if keep_text else []))
    return flat.withColumn("timestamp", parse_utc(F.col("timestamp")))


def drop_sentinel_positions(positions: DataFrame) -> DataFrame:
    """Remove rows whose latitude or longitude is missing, not a number or exactly 0.

    Missing values fail the comparisons with 0, which reach the Parquet scan.
    """
    return positions.filter((F.col("lat") != 0) & (F.col("lon") != 0) & ~F.isnan("lat") & ~F.isnan("lon"))


def drop_unavailable_positions(positions: DataFrame) -> DataFrame:
    """Remove the "position not available" codes (91, 181) and anything above 90/180."""
    return positions.filter((F.col("lat") <= 90) & (F.col("lon") <= 180) & ~F.isnan("lat") & ~F.isnan("lon"))


def within_box(positions: DataFrame, box: Rectangle = DEFAULTS.feed_area) -> DataFrame:
    return positions.filter(in_rectangle(F.col("lat"), F.col("lon"), box))


def nan_to_null(positions: DataFrame) -> DataFrame:
    return positions.withColumns({c: not_nan(F.col(c)) for c in MEASURES if c in positions.columns})


def flag_harbour(positions: DataFrame, settings: Settings = DEFAULTS, polygon=None) -> DataFrame:
    """Add ``in_port``: by the harbour rectangle, or by ``polygon`` when given."""
    lat, lon = F.col("lat"), F.col("lon")
    inside = in_polygon(lat, lon, polygon) if polygon else in_rectangle(lat, lon, settings.harbour)
    return positions.withColumn("in_port", F.coalesce(inside, F.lit(False)))


def to_silver(positions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Clean and flag typed positions. Map-only: no shuffle in batch or stream."""
    return flag_harbour(nan_to_null(drop_sentinel_positions(positions)), settings)


def to_lake(positions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Silver rows with audit time and partition date, cast to the lake schema."""
    stamped = to_silver(positions, settings).withColumns(
        {"ingestion_time": F.current_timestamp(), "date": F.to_date("timestamp")}
    )
    return conform(stamped)


def conform(df: DataFrame) -> DataFrame:
    """Enforce the lake schema: exactly its columns, in order, cast to its types, and ``extra``
    if there is one. A value that does not fit its type becomes null and does not fail the job."""
    types = dict(part.strip().split(" ", 1) for part in schemas.LAKE.split(","))
    extra = [c for c in df.columns if c == "extra"]
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) for c in schemas.LAKE_COLUMNS], *extra)
