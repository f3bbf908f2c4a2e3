"""Port entry and exit events, and visits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS
from wakeline.operators.ordered import SLICE_HOURS, time_slice, with_neighbour

KEY = DEFAULTS.vessel_key


def port_states(
    positions: DataFrame, key: str = KEY, tie: str | None = None, slice_hours: int = SLICE_HOURS
) -> DataFrame:
    """``key, timestamp, in_port``: one state per vessel and instant.

    Of simultaneous reports the one with the greatest ``tie`` decides (null last);
    among equal ties, and without ``tie``, any report inside counts. The
    window's partitioning and order also serve the search for neighbours.
    """
    needed = [key, "timestamp", "in_port", *([tie] if tie else [])]
    window = Window.partitionBy(key, "_slice").orderBy("timestamp", *([tie] if tie else []), "in_port")
    return (
        positions.select(*needed)
        .filter(F.col("timestamp").isNotNull())
        .withColumn("_slice", time_slice(F.col("timestamp"), slice_hours))
        .withColumn("_after", F.lead("timestamp").over(window))
        .filter(F.col("_after").isNull() | (F.col("_after") > F.col("timestamp")))
        .select(key, "timestamp", "in_port")
    )


def _changes(states: DataFrame, key: str, first_inside: bool, slice_hours: int) -> DataFrame:
    """Rows whose state differs from the previous one; with ``first_inside`` also a
    vessel's first row when it is already inside."""

    def changed(previous):
        differs = previous["in_port"] != F.col("in_port")
        return F.coalesce(differs, F.col("in_port") if first_inside else F.lit(False))

    return with_neighbour(
        states, key, "timestamp", ["in_port"], "_before", keep=changed, slice_hours=slice_hours
    )


def changes_of(states: DataFrame, key: str = KEY, slice_hours: int = SLICE_HOURS) -> DataFrame:
    """Entries and exits from rows of ``key, timestamp, in_port``, one per instant."""
    event = F.when(F.col("in_port"), "entry").otherwise("exit")
    changes = _changes(states, key, False, slice_hours)
    return changes.select(key, "timestamp", event.alias("event"))


def port_transitions(
    positions: DataFrame, key: str = KEY, tie: str | None = None, slice_hours: int = SLICE_HOURS
) -> DataFrame:
    """``key, timestamp, event``: one row per entry into or exit from the port.
    A vessel's first report is neither. ``slice_hours`` only sets how the work is
    cut, never the answer."""
    return changes_of(port_states(positions, key, tie, slice_hours), key, slice_hours)


def port_changes(states: DataFrame, key: str = KEY, slice_hours: int = SLICE_HOURS) -> DataFrame:
    """``key, timestamp, event, entry_seen``: entries and exits, and a first report inside as an
    entry that was not seen."""
    event = F.when(F.col("in_port"), "entry").otherwise("exit").alias("event")
    seen = F.col("_before").isNotNull().alias("entry_seen")
    return _changes(states, key, True, slice_hours).select(key, "timestamp", event, seen)


def stays_of(changes: DataFrame, key: str = KEY, slice_hours: int = SLICE_HOURS) -> DataFrame:
    """Stays from what ``port_changes`` gives."""
    # Entries and exits alternate, so the next change after an entry is its exit.
    stays = with_neighbour(
        changes, key, "timestamp", ["timestamp"], "_next", forward=True,
        keep=lambda _: F.col("event") == "entry", slice_hours=slice_hours,
    )
    entered, left = F.col("timestamp"), F.col("_next.timestamp")
    return stays.select(
        key,
        entered.alias("entered_at"),
        left.alias("left_at"),
        "entry_seen",
        ((F.unix_micros(left) - F.unix_micros(entered)) / F.lit(1e6)).alias("dwell_sec"),
    )


def port_visits(
    positions: DataFrame, key: str = KEY, tie: str | None = None, slice_hours: int = SLICE_HOURS
) -> DataFrame:
    """``key, entered_at, left_at, entry_seen, dwell_sec``: one row per stay in port.

    A stay starts at an entry, or at the vessel's first report if that is inside
    (``entry_seen`` false), and ends at the first report outside (null if none).
    """
    return stays_of(port_changes(port_states(positions, key, tie, slice_hours), key, slice_hours), key, slice_hours)
