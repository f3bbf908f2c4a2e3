"""Raw AIS messages to flat position events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.operators.once import evaluate_once

# The two message kinds used, and the texts and codes derived from them.
CLASS_A, CLASS_B = "PositionReport", "StandardClassBPositionReport"
UNDER_WAY_CODES = (0, 8)
NAV_STATUS_DEFAULT = 15
UNDER_WAY, MOORED, CLASS_B_STATUS = "Under way", "Moored/Anchored", "Class B Active"
HEADING_UNAVAILABLE = 511
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

OUTCOMES = ("ok", "malformed", "other_kind", "missing_field", "position_unavailable")


def parse_raw(records: DataFrame) -> DataFrame:
    """Parse ``value`` into ``msg``, keeping every other column."""
    msg = F.from_json(
        F.col("value").cast("string"),
        schemas.RAW_AIS,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    return evaluate_once(records, msg, "msg")


def _field(name: str) -> Column:
    """The field of whichever message body the declared kind selects."""
    kind = F.col("msg.MessageType")
    return F.when(kind == CLASS_A, F.col(f"msg.Message.{CLASS_A}.{name}")).when(
        kind == CLASS_B, F.col(f"msg.Message.{CLASS_B}.{name}")
    )


def nav_status_text(code: Column) -> Column:
    code = F.coalesce(code, F.lit(NAV_STATUS_DEFAULT))
    return F.when(code.isin(*UNDER_WAY_CODES), UNDER_WAY).otherwise(MOORED)


def ship_name_text(name: Column, mmsi: Column) -> Column:
    return F.trim(F.coalesce(name, F.concat(F.lit("Unknown-"), mmsi.cast("string"))), F.lit(BLANKS))


def _heading() -> Column:
    """Class A keeps its heading, 511 included; Class B falls back to course over ground."""
    given = _field("TrueHeading")
    course = F.coalesce(F.col(f"msg.Message.{CLASS_B}.Cog"), F.lit(0.0))
    class_b = F.when(
        F.coalesce(given, F.lit(float(HEADING_UNAVAILABLE))) == HEADING_UNAVAILABLE, course
    ).otherwise(given)
    return F.when(F.col("msg.MessageType") == CLASS_A, F.coalesce(given, F.lit(0.0))).otherwise(class_b)


def outcome() -> Column:
    """What becomes of a parsed message, as one of ``OUTCOMES``."""
    lat, lon = _field("Latitude"), _field("Longitude")
    kind = F.col("msg.MessageType")
    return (
        F.when(F.col("msg").isNull() | (kind.isNull() & F.col("msg._corrupt_record").isNotNull()), "malformed")
        .when(kind.isNull() | ~kind.isin(CLASS_A, CLASS_B), "other_kind")
        .when(_field("UserID").isNull() | lat.isNull() | lon.isNull(), "missing_field")
        .when((lat > 90) | (lon > 180), "position_unavailable")
        .otherwise("ok")
    )


def normalize_ais(records: DataFrame, event_time: Column | None = None) -> DataFrame:
    """Raw records with a ``value`` column to the eight position columns.

    One pass without a union: each output field picks its source by message
    kind. ``event_time`` defaults to the arrival wall clock. Other input
    columns are carried along.
    """
    extra = [c for c in records.columns if c not in ("value", *schemas.POSITION_COLUMNS)]
    stamp = F.current_timestamp() if event_time is None else event_time
    user = _field("UserID")
    return (
        parse_raw(records)
        .filter(outcome() == "ok")
        .select(
            *extra,
            user.try_cast("int").alias("mmsi"),
            ship_name_text(F.col("msg.MetaData.ShipName"), user).alias("ship_name"),
            _field("Latitude").alias("lat"),
            _field("Longitude").alias("lon"),
            F.coalesce(_field("Sog"), F.lit(0.0)).alias("speed"),
            _heading().alias("heading"),
            F.when(
                F.col("msg.MessageType") == CLASS_A,
                nav_status_text(F.col(f"msg.Message.{CLASS_A}.NavigationalStatus")),
            )
            .otherwise(CLASS_B_STATUS)
            .alias("status"),
            stamp.alias("timestamp"),
        )
    )


def ingest_outcomes(records: DataFrame) -> DataFrame:
    """Messages per outcome: how many were used and why the rest were not."""
    return parse_raw(records).groupBy(outcome().alias("outcome")).agg(F.count("*").alias("messages"))
