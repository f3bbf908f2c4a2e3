"""Stream of JSON records to the lake table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline.config import DEFAULTS, Rectangle, Settings
from wakeline.operators.clean import flag_harbour, nan_to_null, parse_events, to_lake, within_box
from wakeline.operators.drift import parse_with_extra
from wakeline.operators.normalize import normalize_ais
from wakeline.operators.quality import with_violations
from wakeline.sources.writers import stream_to_lake, stream_to_table, to_json_records


def start_etl(
    records: DataFrame,
    path: str,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    fmt: str = "parquet",
    every: str | None = "10 seconds",
    quarantine: str | None = None,
    extra: bool = False,
) -> StreamingQuery:
    """Parse, clean, flag and append; no state.

    By default a row is kept if its position is usable. With ``quarantine`` every record
    must meet the whole data contract: the others go there with their text
    (``value``) and the names of the broken rules, so that kept and set aside rows
    add up to what was read. With ``extra`` the lake keeps fields that the schema does not foresee
    (``operators/drift.py``).
    """
    if extra:
        if quarantine:
            raise ValueError("extra fields are kept in the lake or records are set aside, not both")
        return stream_to_lake(to_lake(parse_with_extra(records), settings), path, checkpoint, fmt, every)
    if not quarantine:
        return stream_to_lake(to_lake(parse_events(records), settings), path, checkpoint, fmt, every)
    return stream_to_lake(judged(records, settings), path, checkpoint, fmt, every, quarantine)


def judged(records: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """All records as lake rows with ``value`` and ``violations``, none left out."""
    at_zero = F.when((F.col("lat") == 0) | (F.col("lon") == 0), F.lit("position_zero"))
    checked = with_violations(parse_events(records, keep_text=True))
    checked = checked.withColumn("violations", F.array_compact(F.array_append("violations", at_zero)))
    return flag_harbour(nan_to_null(checked), settings).withColumns(
        {"ingestion_time": F.current_timestamp(), "date": F.to_date("timestamp")}
    )


def start_normalize(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    servers: str | None = None,
    every: str | None = "10 seconds",
    area: Rectangle | None = None,
) -> StreamingQuery:
    """Raw AIS messages to JSON position records: to topic ``target`` when ``servers``
    is given, else to a folder. Records are stamped with their arrival time. With
    ``area`` only positions inside it are passed on."""
    positions = normalize_ais(messages.select("value"))
    records = to_json_records(within_box(positions, area) if area else positions)
    if not servers:
        return stream_to_table(records, target, checkpoint, "text", every, partition_by=None)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_until_stopped(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for the query and stop it cleanly however the wait ends."""
    try:
        query.awaitTermination(timeout) if timeout else query.awaitTermination()
    except KeyboardInterrupt:
        pass
    finally:
        query.stop()
