"""Latest position per vessel against a plain Python answer."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wakeline.operators import latest

T0 = datetime(2024, 1, 1)
SCHEMA = "ship_name STRING, timestamp TIMESTAMP, event_id INT, speed DOUBLE"


def sample(seed=1, n=3000):
    rng = random.Random(seed)
    names = ["HOT"] * 10 + [f"S{i}" for i in range(20)] + [None]
    rows = []
    for i in range(n):
        ts = None if rng.random() < 0.05 else T0 + timedelta(seconds=rng.randrange(200))
        rows.append((rng.choice(names), ts, i, None if rng.random() < 0.1 else float(rng.randrange(9))))
    rows += [("NOTIME", None, n, 1.0), ("NOTIME", None, n + 1, 2.0)]
    return rows + rng.choices(rows, k=n // 3)


def expected(rows):
    best = {}
    for row in rows:
        rank = (row[1] is not None, row[1] or T0, row[2])
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = (rank, row)
    return sorted((r for _, r in best.values()), key=str)


def test_against_plain_python(spark):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = latest.latest_per_vessel(df, ties=["event_id"]).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_no_job_runs_while_the_plan_is_built(spark):
    context = spark.sparkContext
    context.setJobGroup("plan-only", "")
    df = spark.createDataFrame(sample(), SCHEMA)
    latest.latest_per_vessel(df, ties=["event_id"])
    assert not context.statusTracker().getJobIdsForGroup("plan-only")
    context.setLocalProperty("spark.jobGroup.id", None)


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("A", T0, 1, 3.0), ("A", T0, 1, 5.0), ("A", T0, 1, None)]
    for order in (rows, rows[::-1]):
        got = latest.latest_per_vessel(spark.createDataFrame(order, SCHEMA)).collect()
        assert [tuple(r) for r in got] == [("A", T0, 1, 5.0)]


def test_merge_and_as_of(spark):
    rows = sample(2)
    df = spark.createDataFrame(rows, SCHEMA)
    base = latest.latest_per_vessel(df.filter("event_id < 1500"), ties=["event_id"])
    merged = latest.merge_latest(base, df.filter("event_id >= 1500"), ties=["event_id"])
    assert sorted((tuple(r) for r in merged.collect()), key=str) == expected(rows)
    then = latest.as_of(df, F.lit(T0 + timedelta(seconds=50)), "timestamp")
    assert then.count() == sum(1 for r in rows if r[1] and r[1] <= T0 + timedelta(seconds=50))
