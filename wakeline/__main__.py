"""Jobs: ``spark-submit`` this module's folder or run ``python -m wakeline``.

    normalize  raw AIS messages (folder or topic) to JSON position records
    etl        JSON position records to the lake table
    notify     JSON position records to high alerts, each key once
    movements  JSON position records to port entries, exits and stays, late reports included
    silences   JSON position records to notices of vessels that stopped reporting
    traffic    JSON position records to mergeable traffic counts
    compact    few files in place of a closed day's many
    report     every control-room report over the lake table, as Parquet
"""

from __future__ import annotations

import argparse
import os
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from wakeline.config import DEFAULTS
from wakeline.operators.clean import parse_events, to_silver
from wakeline.operators.fleet import CATEGORIES
from wakeline.plans.reports import control_room
from wakeline.session import build_session
from wakeline.sources import readers, writers
from wakeline.streaming import etl, movements, rollups, silence, stateful


LIMITS = ("min_speed_kn", "max_distance_km", "speed_high_kn", "near_port_km", "stopped_near_port_km")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wakeline")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("normalize", "etl", "notify", "movements", "silences", "traffic"):
        job = jobs.add_parser(name)
        job.add_argument("source", help="folder of JSON text, or a topic with --servers")
        job.add_argument("target", help="topic or folder (normalize), lake path (etl), folder (others)")
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--servers", default=os.environ.get("KAFKA_BOOTSTRAP_SERVERS"))
        job.add_argument("--max-offsets", type=int, default=0, help="records per trigger and topic; 200 suits a small host")
        job.add_argument("--every", default="10 seconds")
        job.add_argument("--once", action="store_true", help="drain what is there and end")
        if name == "etl":
            job.add_argument("--format", default="parquet")
            job.add_argument("--quarantine", help="folder for records that break the data contract")
            job.add_argument("--extra", action="store_true", help="keep fields that the schema does not foresee")
        if name == "silences":
            job.add_argument("--limit-sec", type=int, default=int(DEFAULTS.stale_bad_sec), help="longest time without a report")
            job.add_argument("--lateness-sec", type=int, default=int(DEFAULTS.stale_warn_sec), help="how late reports may be")
        if name == "normalize":
            job.add_argument("--area", action="store_true", help="only positions in the configured feed area")
    compact = jobs.add_parser("compact")
    compact.add_argument("lake")
    compact.add_argument("days", nargs="+", type=date.fromisoformat, help="closed days, as YYYY-MM-DD")
    report = jobs.add_parser("report")
    report.add_argument("lake")
    report.add_argument("target")
    report.add_argument("--hours", type=int, default=DEFAULTS.history_hours)
    report.add_argument("--bucket-minutes", type=int, default=DEFAULTS.bucket_minutes)
    report.add_argument("--search", default="")
    report.add_argument("--literal", action="store_true", help="search for the text itself")
    report.add_argument("--status", nargs="+", choices=CATEGORIES, default=list(CATEGORIES))
    report.add_argument("--zone", choices=("inside", "outside"))
    report.add_argument("--min-quality", type=int)
    report.add_argument("--no-alerts", action="store_true")
    report.add_argument("--as-of", help="ISO time, default the clock")
    report.add_argument("--vessel-key", choices=("ship_name", "mmsi"), default=DEFAULTS.vessel_key)
    report.add_argument("--format", default="parquet")
    for name in LIMITS:
        report.add_argument("--" + name.replace("_", "-"), type=float, default=getattr(DEFAULTS, name))
    return parser.parse_args(argv)


def records(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.servers:
        return readers.stream_kafka(spark, args.servers, args.source, args.max_offsets or None)
    return readers.stream_text(spark, args.source)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"wakeline-{args.job}")
    if args.job == "compact":
        for day in args.days:
            writers.compact_day(spark, args.lake, day)
        return
    if args.job == "report":
        settings = DEFAULTS.but(
            history_hours=args.hours, bucket_minutes=args.bucket_minutes, vessel_key=args.vessel_key,
            **{name: getattr(args, name) for name in LIMITS},
        )
        reports = control_room(
            readers.read_lake(spark, args.lake, fmt=args.format), settings, args.as_of, not args.no_alerts,
            readers.newest_day(spark, args.lake),
            search=args.search, literal=args.literal, statuses=args.status, zone=args.zone, min_quality=args.min_quality,
        )
        for name, table in reports.items():
            table.write.mode("overwrite").parquet(f"{args.target}/{name}")
        reports["fleet"].unpersist()
        return
    every = None if args.once else args.every
    if args.job == "normalize":
        run = etl.start_normalize(
            records(spark, args), args.target, args.checkpoint, args.servers, every,
            DEFAULTS.feed_area if args.area else None,
        )
    elif args.job == "etl":
        run = etl.start_etl(
            records(spark, args), args.target, args.checkpoint, fmt=args.format, every=every, quarantine=args.quarantine,
            extra=args.extra,
        )
    else:
        silver = to_silver(parse_events(records(spark, args)))
        places = (silver, args.target, args.checkpoint)
        if args.job == "notify":
            run = stateful.start_alert_notices(*places, every=every)
        elif args.job == "movements":
            run = movements.start_movements(*places, every=every)
        elif args.job == "traffic":
            run = rollups.start_sketches(*places, every=every)
        else:
            run = silence.start_silence_notices(*places, args.limit_sec, args.lateness_sec, every=every)
    etl.run_until_stopped(run)


if __name__ == "__main__":
    main()
