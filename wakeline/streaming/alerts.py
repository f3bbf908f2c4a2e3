"""Alert notifications on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS, Settings
from wakeline.operators.alerts import alert_key, find_alerts, high_alerts
from wakeline.operators.fleet import enrich


def stream_high_alerts(
    silver: DataFrame, settings: Settings = DEFAULTS, remember: str = "1 hour"
) -> DataFrame:
    """Each high alert once per notification key while the key is remembered.

    ``remember`` bounds the state and is also how late a report may be: older ones
    give no notice and are left to the batch report ``distinct_alerts``. A key seen
    again after that is notified again. Only high alerts reach the state, one per key.
    """
    marked = silver.withWatermark("timestamp", remember)
    fleet = enrich(marked, settings, F.col("timestamp"))
    alerts = high_alerts(find_alerts(fleet, settings, carry=["timestamp"]))
    return alerts.withColumn("alert_key", alert_key()).dropDuplicatesWithinWatermark(["alert_key"]).select(
        "priority", "ship", "type", "time", "alert_key", "timestamp"
    )
