"""Data contract: violations per record, valid/quarantine split, counts per rule."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits of the contract.
MMSI_DIGITS = 9
MMSI_MIN, MMSI_MAX = 100_000_000, 999_999_999
LAT_LIMIT, LON_LIMIT = 90, 180
SPEED_LIMIT_KN = 102.2
HEADING_MAX = 360

REQUIRED = ("mmsi", "ship_name", "lat", "lon", "speed", "heading")


def contract_rules() -> dict[str, Column]:
    """Rule name to the condition that breaks it. A missing value breaks only the
    rule that requires it; NaN breaks every range."""
    c = F.col
    mmsi = c("mmsi")
    rules = {f"{name}_missing": c(name).isNull() for name in REQUIRED}
    rules |= {
        "mmsi_digits": F.length(mmsi.cast("string")) != MMSI_DIGITS,
        "mmsi_range": ~mmsi.between(MMSI_MIN, MMSI_MAX),
        "lat_range": ~c("lat").between(-LAT_LIMIT, LAT_LIMIT),
        "lon_range": ~c("lon").between(-LON_LIMIT, LON_LIMIT),
        "speed_negative": c("speed") < 0,
        "speed_limit": c("speed") > SPEED_LIMIT_KN,
        "heading_range": ~c("heading").between(0, HEADING_MAX),
        "timestamp_missing": c("timestamp").isNull(),
    }
    return rules


def with_violations(positions: DataFrame) -> DataFrame:
    """Add ``violations``: names of the broken rules, empty for a valid record."""
    names = [F.when(broken, F.lit(name)) for name, broken in contract_rules().items()]
    return positions.withColumn("violations", F.array_compact(F.array(*names)))


def _any_broken() -> Column:
    """True if some rule is broken; a rule over a missing value is not."""
    return reduce(or_, [F.coalesce(broken, F.lit(False)) for broken in contract_rules().values()])


def valid_positions(positions: DataFrame) -> DataFrame:
    return positions.filter(~_any_broken())


def quarantine(positions: DataFrame) -> DataFrame:
    """The complement of ``valid_positions``, with the reasons."""
    return with_violations(positions.filter(_any_broken()))


def violation_counts(positions: DataFrame) -> DataFrame:
    """Records per broken rule; unbroken rules are left out. All rules are counted
    in one aggregation to a single row, which is then turned into rows."""
    rules = contract_rules()
    counts = positions.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("records")) for name in rules]
    return counts.select(F.inline(F.array(*pairs))).filter(F.col("records") > 0)
