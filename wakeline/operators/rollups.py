"""Traffic over time from mergeable counts: small buckets are counted once and added up later.

A distinct count cannot be added to another one; a sketch of the vessels seen can. Each small
bucket keeps such a sketch beside its row counts, and longer buckets, trailing windows and late rows
are merged from these without another look at the positions. Counts are exact up to some
thousand vessels and within ``relative_error`` beyond; ``timeline.bucketed`` stays the exact form.
"""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS, Settings
from wakeline.functions.times import bucket_start, hours
from wakeline.operators.timeline import bucket_counts

SMALL_MINUTES = 5
#: Binary logarithm of a sketch's cells: at most 16 kB for a bucket, and few bytes for few vessels.
LG_CELLS = 14
ROWS = ("rows_in_port", "rows_moving", "rows_stopped")
SKETCHES = "ts_bin TIMESTAMP, vessels BINARY, rows_in_port BIGINT, rows_moving BIGINT, rows_stopped BIGINT, date DATE"


def relative_error(lg_cells: int = LG_CELLS, deviations: float = 3.0) -> float:
    """Share of the true count that an estimate is off by at most, at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(2**lg_cells)


def bucket_sketches(positions: DataFrame, settings: Settings = DEFAULTS, minutes: int = SMALL_MINUTES, lg_cells: int = LG_CELLS) -> DataFrame:
    """One row per small bucket: ``ts_bin``, a sketch of its ``vessels``, row counts and ``date``.

    Rows without a time are left out, rows without a name are counted as rows only. Each task makes its own
    sketches first, so a busy bucket or vessel meets nowhere.
    """
    name = F.col(settings.vessel_key)
    # a number, as the sketch itself passes over empty names
    seen = F.when(name.isNotNull(), F.xxhash64(name))
    return (
        positions.filter(F.col("timestamp").isNotNull())
        .groupBy(bucket_start(F.col("timestamp"), minutes).alias("ts_bin"))
        .agg(F.hll_sketch_agg(seen, F.lit(lg_cells)).alias("vessels"), *bucket_counts(settings.moving_kn))
        .withColumn("date", F.to_date("ts_bin"))
    )


def _merged() -> list[Column]:
    return [F.hll_union_agg("vessels").alias("vessels"), *[F.sum(c).alias(c) for c in ROWS]]


def roll_up(sketches: DataFrame, minutes: int) -> DataFrame:
    """Buckets of ``minutes``, a multiple of the small ones', from any number of partial rows for each."""
    return sketches.groupBy(bucket_start(F.col("ts_bin"), minutes).alias("ts_bin")).agg(*_merged())


def estimated(sketches: DataFrame) -> DataFrame:
    """The timeline's columns: ``vessels_total`` in place of the sketch."""
    total = F.hll_sketch_estimate("vessels").alias("vessels_total")
    return sketches.select(*[total if c == "vessels" else F.col(c) for c in sketches.columns if c != "date"])


def rolled_timeline(sketches: DataFrame, minutes: int) -> DataFrame:
    return estimated(roll_up(sketches, minutes)).orderBy("ts_bin")


def trailing_total(sketches: DataFrame, window_hours: int, as_of: Column | datetime | None = None) -> DataFrame:
    """One row for all buckets that begin within ``window_hours`` before ``as_of`` (default: the
    newest bucket). Only their dates are read from a table partitioned by ``date``."""
    if as_of is None:
        end = sketches.agg(F.max("ts_bin")).scalar()
    else:
        end = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    start = end - hours(window_hours)
    recent = sketches.filter((F.col("ts_bin") >= start) & (F.col("ts_bin") <= end))
    if "date" in sketches.columns:
        recent = recent.filter(F.col("date") >= F.to_date(start))
    return estimated(recent.agg(*_merged()))


def merged_day(sketches: DataFrame) -> DataFrame:
    """One row per bucket in place of its partial rows; for compaction."""
    return sketches.groupBy("ts_bin").agg(*_merged())
