"""Trigram index of names, fields outside the schema, vessels that fell silent."""

import random
import re
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wakeline.operators import clean, drift, names, silence
from wakeline.operators.fleet import name_matches
from wakeline.session import working_dir
from wakeline.sources import readers, writers
from wakeline.streaming import silence as st_silence, stateful

# --- names -----------------------------------------------------------------------------

NAMES = [f"VESSEL {i:04d}" for i in range(400)] + ["Ñandú", "San José", "ab", "", None, "a.b+c", "FERRY  (LPA)", "ferry one", "FERRY one", "ΑΣ ΟΔΟΣ"]
SEARCHES = [
    ("sel 0+[1-4]", False), ("vessel 00", True), ("^ferry", False), ("FERRY", True), ("josé", True), ("a.b+", True), ("a\\.b\\+c", False),
    ("(ferry|vessel) 0", False), ("ab", True), ("one$", False), ("ssel 03?9", False), ("sel [^]]*7", False), (".*", False), ("ΑΣ", True), ("\\(LPA\\)", False),
]


@pytest.mark.parametrize("pattern, literal", SEARCHES)
def test_index_finds_what_a_scan_finds(spark, pattern, literal):
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(NAMES + NAMES[:5])], "ship_name STRING, id INT")
    got = names.search_positions(rows, names.name_index(rows), pattern, literal).select("id").collect()
    want = rows.filter(name_matches(F.col("ship_name"), pattern, literal)).select("id").collect()
    assert sorted(got) == sorted(want)


def test_index_narrows_the_search(spark):
    rows = spark.createDataFrame([(n,) for n in NAMES], "ship_name STRING")
    index = names.name_index(rows)
    assert names.candidates(index, names.required_runs("vessel 003", True)).count() == 11  # VESSEL 0003 has the same trigrams
    assert names.candidates(index, names.required_runs("sel 03+[1-4]")).count() <= 111
    path = working_dir(spark, "names")
    names.write_index(index, path)
    back = readers.read_table(spark, path, names.INDEX)
    plan = names.candidates(back, ["ferry"])._jdf.queryExecution().executedPlan().toString()
    assert "In(trigram" in plan and back.count() == index.count()


@settings(max_examples=300, deadline=None)
@given(st.from_regex(r"[a-c.]{0,3}(ab[cx]?|\\\.|[a-c][*+?]|\[a-c\]|\(ab\)\??|x\{2\}|a\{0,1\})[a-c ]{0,4}(bca[*?]?)?[a-c]{0,3}", fullmatch=True), st.randoms())
def test_runs_are_in_every_match(pattern, rng):
    compiled = re.compile(pattern, re.I)
    runs = names.required_runs(pattern)
    for _ in range(50):
        text = "".join(rng.choice("abcABC.x ") for _ in range(rng.randrange(4, 14)))
        if compiled.search(text):
            assert all(r in text.lower() for r in runs), (pattern, text, runs)


# --- fields outside the schema ---------------------------------------------------------------


def extras(spark, *texts):
    rows = drift.parse_with_extra(spark.createDataFrame([(t,) for t in texts], "value STRING"))
    return [(r["mmsi"], r["speed"], r["extra"]) for r in rows.withColumn("extra", F.to_json("extra")).collect()]


def test_unknown_and_ill_typed_fields_are_kept(spark):
    assert extras(
        spark,
        '{"mmsi": 224000001, "speed": 1.5}',
        '{"mmsi": 99999999999, "speed": "fast", "draught": [1, {"a": null}]}',
        '{"mmsi": 1, "speed": null, "new": null}',
        '{"mmsi": 1, "speed": 2, "timestamp": "yesterday"}',
        "not json", "[1, 2]", "", None,
    ) == [
        (224000001, 1.5, None),
        (None, None, '{"draught":[1,{"a":null}],"mmsi":99999999999,"speed":"fast"}'),
        (1, None, None),
        (1, 2.0, '{"timestamp":"yesterday"}'),
        (None, None, None), (None, None, "[1,2]"), (None, None, None), (None, None, None),
    ]


def test_extra_goes_through_the_lake(spark, tmp_path):
    path = str(tmp_path / "lake")
    text = '{"mmsi": 1, "lat": 28.1, "lon": -15.4, "timestamp": "2024-01-05T00:00:00Z", "draught": 4.5}'
    rows = clean.to_lake(drift.parse_with_extra(spark.createDataFrame([(text,)], "value STRING")))
    writers.append_lake(rows.drop("extra"), path, load="a")
    writers.append_lake(rows, path, load="b")
    writers.append_lake(rows, path, clustered=True, load="c")
    writers.append_lake(rows.drop("extra"), path, load="d")
    writers.compact_day(spark, path, datetime(2024, 1, 5).date())
    lake = readers.read_lake(spark, path, extra=True)
    found = lake.select(F.try_variant_get("extra", "$.draught", "double").alias("d")).collect()
    assert sorted((r["d"] for r in found), key=str) == [4.5, 4.5, None, None]
    assert "extra" not in readers.read_lake(spark, path).columns


# --- silence ------------------------------------------------------------------------------

T0 = datetime(2024, 1, 1)
REPORT = "ship_name STRING, timestamp TIMESTAMP"


def by_hand(rows, limit, until):
    found = set()
    for ship in {s for s, _ in rows}:
        times = sorted({t for s, t in rows if s == ship and t is not None})
        for a, b in zip(times, [*times[1:], None], strict=True):
            if (b or until) - a > limit:
                found.add((ship, a, b))
    return found


def test_silences_of_a_batch(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["A", "B", "C", None]), T0 + timedelta(hours=rng.randrange(24 * 20))) for _ in range(120)] + [("A", None), ("D", T0)]
    until, limit = T0 + timedelta(days=20), timedelta(hours=12)
    df = spark.createDataFrame(rows, REPORT)
    got = {tuple(r) for r in silence.silences(df, limit.total_seconds(), F.lit(until)).collect()}
    assert got == by_hand(rows, limit, until)


def test_a_timer_needs_no_report_of_the_silent_vessel(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    hour = lambda h: T0 + timedelta(hours=h)
    batches = [[("A", hour(0)), ("B", hour(0))], [("B", hour(5))], [("B", hour(14))], [("B", hour(15)), ("A", hour(15))], [("B", hour(40))], [("B", hour(41))]]
    seen = []
    for rows in batches:
        spark.createDataFrame(rows, REPORT).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(REPORT).parquet(source)
        st_silence.start_silence_notices(stream, root, str(tmp_path / "c"), 12 * 3600, 3600, every=None).awaitTermination()
        notices = stateful.read_versions(spark, root, "ship_name STRING, silent_since TIMESTAMP, due_at TIMESTAMP").collect()
        seen.append(sorted((r["ship_name"], (r["silent_since"] - T0) / timedelta(hours=1), (r["due_at"] - T0) / timedelta(hours=1)) for r in notices))
    first, second, third = ("A", 0.0, 12.0), ("A", 15.0, 27.0), ("B", 15.0, 27.0)
    assert seen == [[], [], [first], [first], [first, second, third], [first, second, third]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 100), min_size=1, max_size=12), st.integers(1, 30), st.randoms())
def test_settling_in_any_order(times, limit, rng):
    """However reports within the lateness are dealt into batches, each silence is found once."""
    lateness = limit
    shuffled = sorted(times, key=lambda t: t + rng.randrange(lateness + 1))
    settled, noticed, pending, found, newest = None, False, [], [], -1000
    for t in shuffled:
        watermark = newest - lateness
        if t >= watermark:
            pending.append(t)
        newest = max(newest, t)
        settled, noticed, pending, new = st_silence._settle(settled, noticed, pending, limit, watermark)
        found += new
    settled, noticed, pending, new = st_silence._settle(settled, noticed, pending, limit, 10**6)
    found += new
    known = sorted(set(times))
    want = [a for a, b in zip(known, [*known[1:], 10**6], strict=True) if b - a > limit]
    assert found == want


def test_lateness_beyond_the_limit_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        st_silence.start_silence_notices(spark.createDataFrame([], REPORT), "x", "y", 10, 20)
