"""Port entries, exits and stays on a stream, late reports included.

Reports newer than the last known one of their vessel continue its sequence from that state. The others
are late: the days of the vessel that they fall into are worked out again from all its reports of
those days and of the neighbouring days it reported on, once without and once with the late ones, and
the difference is emitted as corrections. History is read for these days only, and only if
something is late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StructField, StructType

from wakeline.config import DEFAULTS
from wakeline.operators.visits import changes_of, port_changes, port_states, stays_of
from wakeline.sources.readers import read_table
from wakeline.sources.snapshots import BUCKETS, KEPT_VERSIONS, bucket_of, changed_parts, read_parts, read_snapshot, upsert, write_version
from wakeline.sources.writers import write_load
from wakeline.streaming.stateful import save_version, start, version_path

KEY = DEFAULTS.vessel_key
NO_DAYS = "array<date>"


def _schema(key: str, kind: DataType, rest: str) -> StructType:
    return StructType([StructField(key, kind), *StructType.fromDDL(rest).fields])


def changes_schema(key: str = KEY, kind: DataType | None = None) -> StructType:
    return _schema(key, kind or StructType.fromDDL("k STRING")["k"].dataType, "timestamp TIMESTAMP, event STRING, entry_seen BOOLEAN")


def stays_schema(key: str = KEY, kind: DataType | None = None) -> StructType:
    rest = "entered_at TIMESTAMP, left_at TIMESTAMP, entry_seen BOOLEAN, dwell_sec DOUBLE"
    return _schema(key, kind or StructType.fromDDL("k STRING")["k"].dataType, rest)


def _load(version: int) -> str:
    return f"v{version:012d}"


def _reports(batch: DataFrame, key: str, tie: str | None) -> DataFrame:
    order = F.col(tie) if tie else F.lit(None).cast("long")
    rows = batch.select(key, "timestamp", F.coalesce("in_port", F.lit(False)).alias("in_port"), order.alias("tie"))
    return rows.filter(F.col("timestamp").isNotNull()).withColumn("day", F.to_date("timestamp"))


def _states(reports: DataFrame, key: str) -> DataFrame:
    """Last report and days with reports of each vessel; of simultaneous ones the last as ``port_states`` has it."""
    last = reports.groupBy(key).agg(F.max(F.struct("timestamp", "tie", "in_port")).alias("last"), F.collect_set("day").alias("days"))
    return last.select(key, "last.*", "days")


def _later(before: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    last, days = F.max(F.struct("timestamp", "tie", "in_port")), F.array_distinct(F.flatten(F.collect_list("days")))
    return before.unionByName(changed).groupBy(key).agg(last.alias("last"), days.alias("days")).select(key, "last.*", "days")


def _net(before: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Changes that stand after corrections."""
    both = before.withColumn("sign", F.lit(1)).unionByName(delta)
    columns = [key, "timestamp", "event", "entry_seen"]
    return both.groupBy(*columns).agg(F.sum("sign").alias("sign")).filter("sign > 0").select(*columns)


def _meeting(rows: DataFrame, slices: DataFrame, key: str) -> DataFrame:
    """Rows of the (vessel, day) slices, a vessel without a name being one."""
    wanted = slices.select(F.col(key).alias("_key"), F.col("day").alias("_day")).distinct()
    return rows.join(wanted, F.col(key).eqNullSafe(F.col("_key")) & (F.col("day") == F.col("_day")), "left_semi")


def _continued(fresh: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Changes by reports that come after what is known; ``fresh`` has ``_known``, the time of that."""
    plain = fresh.drop("_known")
    begun = plain.filter(F.col("_known").isNotNull())
    # the known state opens the new sequence; as the first row it is no change itself
    vessels = begun.select(F.col(key).alias("_key")).distinct()
    opening = known.join(vessels, F.col(key).eqNullSafe(F.col("_key")), "left_semi").select(key, "timestamp", "in_port")
    sequence = port_states(begun, key, "tie").unionByName(opening)
    first = port_changes(port_states(plain.filter(F.col("_known").isNull()), key, "tie"), key)
    return changes_of(sequence, key).withColumn("entry_seen", F.lit(True)).unionByName(first)


def _slices(fresh: DataFrame, late: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``key, day, settled``: days of vessels to be read for the late reports, and whether their changes may differ."""
    touched = late.select(key, "day").distinct()
    mine = known.select(F.col(key).alias("_key"), F.col("days").alias("_days"))
    more = fresh.unionByName(late).groupBy(F.col(key).alias("_new")).agg(F.collect_set("day").alias("_more"))
    placed = touched.join(mine, F.col(key).eqNullSafe(F.col("_key")), "left").join(more, F.col(key).eqNullSafe(F.col("_new")), "left")
    none = F.array().cast(NO_DAYS)
    days = F.array_union(F.coalesce("_days", none), F.coalesce("_more", none))
    before = F.array_max(F.filter(days, lambda d: d < F.col("day")))
    after = F.array_min(F.filter(days, lambda d: d > F.col("day")))
    # on the day after, only its first report has another predecessor; of the day before only the last report counts
    own = [F.struct(d.alias("day"), F.lit(s).alias("settled")) for d, s in ((F.col("day"), True), (after, True), (before, False))]
    around = placed.select(key, F.explode(F.array(*own)).alias("_slice")).select(key, "_slice.*")
    return around.filter("day IS NOT NULL").groupBy(key, "day").agg(F.max("settled").alias("settled"))


def _corrections(root: str, version: int, fresh: DataFrame, late: DataFrame, slices: DataFrame, key: str) -> DataFrame:
    """What the late reports take back (``sign`` -1) and add (1).

    Both sequences, without and with them, are worked out in one pass, each vessel being there once for each.
    """
    spark = late.sparkSession
    # literal dates prune the scan; there are no more of them than days of history
    dates = [r[0] for r in slices.select("day").distinct().collect()]
    schema = StructType(list(late.schema.fields)).add("load", "string")
    history = read_table(spark, f"{root}/reports", schema).filter(F.col("day").isin(dates) & (F.col("load") < _load(version)))
    both, only_now = F.array(F.lit(False), F.lit(True)), F.array(F.lit(True))
    old = _meeting(history.select(*late.columns).unionByName(fresh), slices, key).withColumn("_now", F.explode(both))
    rows = old.unionByName(late.withColumn("_now", F.explode(only_now)))
    rows = rows.withColumn("_side", F.struct("_now", F.col(key).alias("vessel"))).drop(key)
    found = port_changes(port_states(rows, "_side", "tie"), "_side")
    found = found.select(F.col("_side.vessel").alias(key), "timestamp", "event", "entry_seen", "_side._now", F.to_date("timestamp").alias("day"))
    # an instant has one state, so a change is there once on a side at most
    sign = F.sum(F.when(F.col("_now"), 1).otherwise(-1)).cast("int").alias("sign")
    changes = _meeting(found, slices.filter("settled"), key)
    return changes.groupBy(key, "timestamp", "event", "entry_seen").agg(sign).filter("sign <> 0")


def start_movements(
    silver: DataFrame, root: str, checkpoint: str, key: str = KEY, tie: str | None = None,
    every: str | None = "10 seconds", buckets: int = BUCKETS, retain: int = KEPT_VERSIONS,
) -> StreamingQuery:
    """Port entries, exits and stays per micro-batch, under ``root``.

    ``changes/``: ``key, timestamp, event, entry_seen, sign``, every entry and exit as it is found (sign 1) or
    taken back (-1), for consumers that follow; a first report inside is an entry not seen. ``events/`` and
    ``stays/``: what stands after all corrections, as tables of which only the buckets of vessels with a
    change are rewritten. ``reports/`` and ``state/`` are the stream's own memory: all reports by
    day, and per vessel the last one and the days it reported on. A batch that runs again
    overwrites its own version of each.
    """
    kind = silver.schema[key].dataType
    standing = changes_schema(key, kind)

    def handle(batch: DataFrame, version: int) -> None:
        spark = batch.sparkSession
        reports = _reports(batch, key, tie)
        known = read_snapshot(spark, f"{root}/state", _states(reports, key).schema, version - 1)
        ages = known.select(F.col(key).alias("_key"), F.col("timestamp").alias("_known"))
        # a vessel has one state at most, so reports stay as they are
        aged = reports.join(ages, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key").persist()
        slices = None
        try:
            reports = aged.drop("_known")
            states = _states(reports, key)
            is_late = F.coalesce(F.col("timestamp") <= F.col("_known"), F.lit(False))
            fresh, late = aged.filter(~is_late), aged.filter(is_late).drop("_known")
            delta = _continued(fresh, known, key).withColumn("sign", F.lit(1))
            if not late.isEmpty():
                slices = _slices(fresh.drop("_known"), late, known, key).persist()
                delta = delta.unionByName(_corrections(root, version, fresh.drop("_known"), late, slices, key))
            write_load(reports.hint("rebalance", "day"), f"{root}/reports", "parquet", _load(version), "day")
            save_version(delta, f"{root}/changes", version)
            delta = spark.read.schema(delta.schema).parquet(version_path(f"{root}/changes", version))
            upsert(delta, f"{root}/events", version, [key], lambda a, b: _net(a, b, key), buckets, retain, standing)
            rewritten = changed_parts(spark, f"{root}/events", version)
            if rewritten:
                stays = stays_of(read_parts(spark, rewritten.values(), standing), key)
                write_version(stays.withColumn("bucket", bucket_of([key], buckets)), f"{root}/stays", version, buckets, rewritten, retain)
            upsert(states, f"{root}/state", version, [key], lambda a, b: _later(a, b, key), buckets, retain)
        finally:
            aged.unpersist()
            if slices is not None:
                slices.unpersist()

    return start(silver, handle, checkpoint, "append", every)


def read_transitions(spark: SparkSession, root: str, key: str = KEY, kind: DataType | None = None) -> DataFrame:
    """Entries and exits as ``port_transitions`` gives them; a vessel's first report is neither."""
    events = read_snapshot(spark, f"{root}/events", changes_schema(key, kind))
    return events.filter((F.col("event") == "exit") | F.col("entry_seen")).drop("entry_seen")


def read_stays(spark: SparkSession, root: str, key: str = KEY, kind: DataType | None = None) -> DataFrame:
    """Stays as ``port_visits`` gives them, open ones included."""
    return read_snapshot(spark, f"{root}/stays", stays_schema(key, kind))
