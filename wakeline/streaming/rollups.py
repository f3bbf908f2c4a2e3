"""Traffic counts on a stream as a table of mergeable partial counts."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wakeline.config import DEFAULTS, Settings
from wakeline.operators.rollups import SKETCHES, bucket_sketches
from wakeline.sources.readers import read_table
from wakeline.sources.writers import write_load
from wakeline.streaming.stateful import start


def start_sketches(
    silver: DataFrame, path: str, checkpoint: str, settings: Settings = DEFAULTS, every: str | None = "10 seconds"
) -> StreamingQuery:
    """Count every micro-batch into small buckets and append these, as one load named by its number.

    Nothing is kept between batches: a bucket has one partial row per batch that had rows for it, late
    ones however late, and readers add them up. A batch that runs again replaces its own load.
    """
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def handle(batch: DataFrame, number: int) -> None:
        partial = bucket_sketches(batch, settings).hint("rebalance", "date")
        write_load(partial, path, "parquet", f"stream-{stream}-{number:012d}", "date")

    return start(silver, handle, checkpoint, "append", every)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """Partial rows of all buckets; an empty table before the first load."""
    return read_table(spark, path, SKETCHES).drop("load")
