"""Batch and stream sinks."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline import schemas
from wakeline.functions.curve import hilbert_key
from wakeline.operators.clean import conform

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def to_json_records(positions: DataFrame) -> DataFrame:
    """One JSON record per position in ``value``, times to the microsecond in UTC."""
    record = F.struct(*[c for c in schemas.POSITION_COLUMNS if c in positions.columns])
    return positions.select(F.to_json(record, {"timestampFormat": TIME_FORMAT}).alias("value"))


def publish(positions: DataFrame, target: str, servers: str | None = None) -> None:
    """Write JSON records to topic ``target`` when ``servers`` is given, else to a folder."""
    records = to_json_records(positions)
    if servers:
        writer = records.write.format("kafka").option("kafka.bootstrap.servers", servers)
        writer.option("topic", target).save()
    else:
        records.write.mode("append").text(target)


def append_lake(
    rows: DataFrame,
    path: str,
    fmt: str = "parquet",
    rebalance: bool = True,
    load: str | None = None,
    clustered: bool = False,
    **options: str,
) -> None:
    """Append to the lake table, enforcing its schema.

    Batches and streams share one layout: by ``date``, and within it by ``load``, the
    name of what wrote the files. Writing a load of the same name again replaces
    its files and adds none. Rebalancing by date gives few files per date, and splits a
    date that holds most rows over several tasks. Rows already grouped by date,
    such as one day's load, do not need that shuffle. ``clustered`` lays the rows of a
    date out along a curve over the map instead (see ``along_curve``). ``options`` go to the writer.
    """
    load = load or f"batch-{uuid.uuid4().hex}"
    table = conform(rows)
    if clustered:
        table = along_curve(table, load)
    elif rebalance:
        table = table.hint("rebalance", "date")
    write_load(table, path, fmt, load, "date", **options)


def along_curve(table: DataFrame, load: str) -> DataFrame:
    """``table`` in ranges of (date, place on a curve over the map), in that order within each.

    A file, and a row group in it, then holds one patch of the map, and its least and greatest
    latitude and longitude tell a scan for a box whether to read it. Ranges are taken from a
    sample, so a busy harbour is split over tasks. Rows without a position come first.
    """
    placed = table.withColumns({"_curve": hilbert_key(F.col("lat"), F.col("lon")), "load": F.lit(load)})
    # the writer sorts by its folders; rows that come in that order already are left as they are
    ordered = placed.repartitionByRange("date", "_curve").sortWithinPartitions("date", "load", "_curve")
    return ordered.drop("_curve")


def write_load(table: DataFrame, path: str, fmt: str, load: str, *by: str, **options: str) -> None:
    """Write ``table`` as the load of that name, in place of what the same load wrote before."""
    (
        table.withColumn("load", F.lit(load))
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*by, "load")
        .save(path)
    )


def compact_day(
    spark: SparkSession,
    path: str,
    day: date,
    fmt: str = "parquet",
    arrange: Callable[[DataFrame], DataFrame] | None = None,
    **options: str,
) -> None:
    """One load in place of all loads of ``day``, arranged by ``arrange``; without it rows are laid
    out along a curve over the map. For days that nothing is written to any more.

    The new load is complete before an old one goes. Old loads are hidden by a change of name, the new one
    is moved in, and only then are files deleted: a reader that lists the day in between misses it for as
    long as these names take to change. A run that was broken off is finished by the next.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    folder = f"{path}/date={day:%Y-%m-%d}"
    target, staged = hadoop(f"{folder}/load=compacted"), hadoop(f"{path}/_compacting/date={day:%Y-%m-%d}")
    files = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(hadoop(staged, "_SUCCESS")):
        # columns that only some loads have are kept
        rows = spark.read.format(fmt).option("mergeSchema", True).load(folder).drop("load", "date")
        rows = arrange(rows) if arrange else along_curve(rows.withColumn("date", F.lit(day)), "").drop("load", "date")
        rows.write.format(fmt).mode("overwrite").options(**options).save(str(staged))
    for status in files.globStatus(hadoop(f"{folder}/load=*")):
        files.rename(status.getPath(), hadoop(f"{folder}/_replaced-{uuid.uuid4().hex}"))
    files.rename(staged, target)
    for status in files.globStatus(hadoop(f"{folder}/_replaced-*")):
        files.delete(status.getPath(), True)


def export_csv(table: DataFrame, folder: str, stem: str = "fleet_filtered") -> str:
    """Write ``table`` as CSV with a header into a time-stamped folder; its path is returned."""
    target = f"{folder}/{stem}_{datetime.now(timezone.utc):%Y%m%d_%H%M%S_%f}"
    table.write.option("header", True).csv(target)
    return target


def client_rows(table: DataFrame, rows: int = 1_000) -> pd.DataFrame:
    """At most ``rows`` rows for a client; more are never sent to the driver."""
    return table.limit(rows).toPandas()


def stream_to_table(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = "10 seconds",
    partition_by: str | None = "date",
) -> StreamingQuery:
    """Start an exactly-once append sink. ``every=None`` drains what is there and ends."""
    writer = (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stream_to_lake(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = "10 seconds",
    quarantine: str | None = None,
) -> StreamingQuery:
    """Start an append of each micro-batch to the lake, as one load named by the stream and
    the number of the batch: a batch that runs again replaces its own files.

    With ``quarantine``, rows that have ``violations`` go there instead, with all their columns.
    """
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def handle(batch: DataFrame, number: int) -> None:
        load = f"stream-{stream}-{number:012d}"
        if not quarantine:
            append_lake(batch, path, fmt, load=load)
            return
        batch = batch.persist()
        try:
            broken = F.size("violations") > 0
            append_lake(batch.filter(~broken), path, fmt, load=load)
            write_load(batch.filter(broken), quarantine, fmt, load)
        finally:
            batch.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle).trigger(**trigger).start()
    )
