"""Entry, exit and stays: plain and sliced forms against a Python walk."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wakeline.operators import visits
from wakeline.operators.ordered import time_slice, with_neighbour

T0 = datetime(2024, 1, 1)
SCHEMA = "ship_name STRING, timestamp TIMESTAMP, in_port BOOLEAN, event_id INT"


def sample(seed, n=4000):
    """A third of all reports from one vessel, many exact copies, simultaneous reports."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        name = "HOT" if rng.random() < 0.34 else rng.choice([None, *(f"S{k}" for k in range(40))])
        tie = None if rng.random() < 0.2 else rng.randrange(3) if rng.random() < 0.3 else i
        rows.append((name, T0 + timedelta(seconds=rng.randrange(n)), rng.random() < 0.4, tie))
    copy = ("HOT", T0 + timedelta(seconds=5), True, n)
    return rows + [copy] * (n // 3) + [("LATE", None, True, n + 1)]


def walk(rows):
    """(transitions, stays) by going through each vessel's reports in order."""
    by_ship = {}
    for name, ts, inside, event_id in rows:
        if ts is not None:
            seen = by_ship.setdefault(name, {})
            rank = (event_id is not None, event_id or 0, inside)
            if ts not in seen or rank > seen[ts][0]:
                seen[ts] = (rank, inside)
    moves, stays = [], []
    for name, seen in by_ship.items():
        before, entered = None, None
        for ts in sorted(seen):
            inside = seen[ts][1]
            if before is not None and inside != before:
                moves.append((name, ts, "entry" if inside else "exit"))
            if inside and not before:
                entered = (ts, before is not None)
            if before and not inside:
                stays.append((name, entered[0], ts, entered[1], (ts - entered[0]).total_seconds()))
            before = inside
        if before:
            stays.append((name, entered[0], None, entered[1], None))
    return sorted(moves, key=str), sorted(stays, key=str)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("slice_hours", [24, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_walk(spark, seed, slice_hours):
    rows = sample(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(9)
    moves, stays = walk(rows)
    assert tuples(visits.port_transitions(df, tie="event_id", slice_hours=slice_hours)) == moves
    assert tuples(visits.port_visits(df, tie="event_id", slice_hours=slice_hours)) == stays


def test_entries_and_exits_alternate(spark):
    df = spark.createDataFrame(sample(3), SCHEMA)
    last = {}
    moves = visits.port_transitions(df).orderBy("ship_name", "timestamp").collect()
    for r in moves:
        assert last.get(r["ship_name"]) != r["event"]
        last[r["ship_name"]] = r["event"]


def test_without_tie_any_report_inside_counts(spark):
    rows = [("A", T0, False, 1), ("A", T0 + timedelta(seconds=1), True, 2), ("A", T0 + timedelta(seconds=1), False, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    for slice_hours in (24, 1):
        got = tuples(visits.port_transitions(df, slice_hours=slice_hours))
        assert got == [("A", T0 + timedelta(seconds=1), "entry")]


@pytest.mark.parametrize("slice_hours", [24, 1])
def test_null_and_equal_ties(spark, slice_hours):
    """Null ties lose to others; among equal ties a report inside counts."""
    at = [T0 + timedelta(hours=h) for h in range(5)]
    rows = [("A", at[0], False, None), ("A", at[1], True, None), ("A", at[2], False, 3), ("A", at[2], True, None),
            ("A", at[3], False, 7), ("A", at[3], True, 7), (None, at[0], False, None), (None, at[4], True, None)]
    got = tuples(visits.port_transitions(spark.createDataFrame(rows, SCHEMA), tie="event_id", slice_hours=slice_hours))
    assert got == sorted([("A", at[1], "entry"), ("A", at[2], "exit"), ("A", at[3], "entry"), (None, at[4], "entry")], key=str)


def test_a_busy_vessel_is_cut_into_slices(spark):
    """No window partition holds most of the hot vessel's rows."""
    hours = [("HOT", T0 + timedelta(minutes=i), True, i) for i in range(6000)]
    df = spark.createDataFrame(hours, SCHEMA)
    sizes = [r["count"] for r in df.groupBy("ship_name", time_slice(F.col("timestamp"))).count().collect()]
    assert len(sizes) == 5 and max(sizes) == 1440


@pytest.mark.parametrize("forward", [False, True])
def test_slices_do_not_change_neighbours(spark, forward):
    rng = random.Random(5)
    times = rng.sample(range(-200_000, 400_000), 2000)
    rows = [(rng.choice("AAAB"), T0 + timedelta(seconds=s), rng.randrange(5)) for s in times]
    df = spark.createDataFrame(rows, "k STRING, o TIMESTAMP, v INT").repartition(5)
    want = []
    for k in "AB":
        own = sorted((r for r in rows if r[0] == k), key=lambda r: r[1], reverse=forward)
        want += [(*r, (b[2], b[1]) if b else None) for b, r in zip([None, *own], own)]
    for slice_hours in (1, 24, 10_000):
        got = with_neighbour(df, "k", "o", ["v", "o"], "near", forward, slice_hours=slice_hours)
        found = [(r["k"], r["o"], r["v"], tuple(r["near"]) if r["near"] else None) for r in got.collect()]
        assert sorted(found, key=str) == sorted(want, key=str)
