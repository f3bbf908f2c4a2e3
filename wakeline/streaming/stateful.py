"""Keyed state on a stream: latest positions and alert notices.

Latest positions are kept as a table in hash buckets, of which a micro-batch rewrites those it
touches. Which alerts were notified is remembered by Spark's own state store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline.config import DEFAULTS, Settings
from wakeline.operators.alerts import alert_key, find_alerts, high_alerts
from wakeline.operators.fleet import enrich
from wakeline.operators.latest import latest_per_vessel, merge_latest
from wakeline.sources.readers import read_table
from wakeline.sources.snapshots import BUCKETS, KEPT_VERSIONS, upsert

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start(
    rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    mode: str, every: str | None,
) -> StreamingQuery:
    """``handle`` for every micro-batch and its number. ``every=None`` drains what is there and ends."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
        .trigger(**trigger)
        .start()
    )


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB: looked up by key, on disk, behind Bloom filters."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def version_path(root: str, version: int) -> str:
    return f"{root}/v={version:012d}"


def save_version(rows: DataFrame, root: str, version: int) -> None:
    """What one micro-batch gives; if it runs again, it overwrites its own."""
    rows.write.mode("overwrite").parquet(version_path(root, version))


def read_versions(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All versions together, for outputs that accumulate."""
    return read_table(spark, root, schema).drop("v")


def stream_latest(
    silver: DataFrame, key: str = DEFAULTS.vessel_key, ties: Sequence[str] = ()
) -> DataFrame:
    """Latest position per vessel as a streaming aggregation; use in update mode."""
    return latest_per_vessel(silver, key, ties=ties)


def start_latest_snapshots(
    latest: DataFrame, root: str, checkpoint: str, key: str = DEFAULTS.vessel_key,
    ties: Sequence[str] = (), every: str | None = "10 seconds", buckets: int = BUCKETS, retain: int = KEPT_VERSIONS,
) -> StreamingQuery:
    """Upsert the vessels that changed; every micro-batch is a version of the table under ``root``
    (``snapshots.read_snapshot``) and writes the buckets of these vessels only."""

    def merge(before: DataFrame, changed: DataFrame) -> DataFrame:
        return merge_latest(before, changed, key=key, ties=ties)

    def handle(changed: DataFrame, version: int) -> None:
        upsert(changed, root, version, [key], merge, buckets, retain)

    return start(latest, handle, checkpoint, "update", every)


NOTICE = "priority STRING, ship STRING, type STRING, time STRING, alert_key STRING"


def start_alert_notices(
    silver: DataFrame, root: str, checkpoint: str, settings: Settings = DEFAULTS,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """High alerts whose key no earlier report has had, under ``root``.

    The keys are remembered for good, so a report is not refused for being late; they hold the time of day
    and not the date, which bounds their number. Of each micro-batch only its own alerts are looked
    up: earlier notices are not read again.
    """
    fleet = enrich(silver, settings, F.col("timestamp"))
    alerts = high_alerts(find_alerts(fleet, settings)).withColumn("alert_key", alert_key())
    fresh = alerts.select("priority", "ship", "type", "time", "alert_key").dropDuplicates(["alert_key"])
    with state_on_disk(silver.sparkSession):
        return start(fresh, lambda batch, version: save_version(batch, root, version), checkpoint, "append", every)
