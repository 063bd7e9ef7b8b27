"""Command line: ``python -m adpulse.jobs <job> ...``, also through ``spark-submit``.

Paths, days and waiting times are arguments. Master, memory and credentials belong to
the cluster's own configuration.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from adpulse.functions.days import days_between
from adpulse.functions.hours import hours_between
from adpulse.model import GRACE_HOURS, LATENESS, POST, PRODUCT, WALL_IMPRESSION
from adpulse.plans import daily, hourly, insights, streams
from adpulse.sources.landing import PARTITIONED, PLAIN, store_landing
from adpulse.streaming.changelog import COMPACT_EVERY
from adpulse.streaming.runs import state_settings, wait

PAIRS = {"product": PRODUCT, "post": POST}
LAYOUTS = {"plain": PLAIN, "partitioned": PARTITIONED}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="adpulse")
    parser.add_argument("--time-zone", default="UTC", help="zone of time text without offset")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *inputs: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for argument in (*inputs, "target"):
            sub.add_argument(f"--{argument}", required=True)
        return sub

    for name, days in (
        ("daily-count", ["day"]),
        ("daily-rate", ["day"]),
        ("daily-all", ["first", "last"]),
    ):
        sub = job(name, "source", *days)
        sub.add_argument("--grace-hours", type=int, default=GRACE_HOURS)
        sub.add_argument("--layout", choices=LAYOUTS, default="plain")
        sub.add_argument("--allow-missing", action="store_true")
        sub.add_argument(
            "--from-table", action="store_true", help="the source is what store-landing wrote"
        )
        if name != "daily-all":
            sub.add_argument("--by-label", action="store_true", help="go by DAY, not event time")
    job("count-change", "source", "day")
    job("rate-change", "source", "day")
    sub = job("store-landing", "source", "first", "last")
    sub.add_argument("--layout", choices=LAYOUTS, default="plain")
    sub.add_argument("--allow-missing", action="store_true")
    for name in ("hour-count", "recount-late"):
        sub = job(name, "source")
        sub.add_argument("--first", help="hour to start with, e.g. 2021-06-30T05")
        sub.add_argument("--layout", choices=LAYOUTS, default="plain")
        if name == "hour-count":
            sub.add_argument("--every", default="1 minute", help="or 'once' to end when caught up")
            sub.add_argument("--close-after", type=int, default=hourly.CLOSE_AFTER, help="hours")
            sub.add_argument("--wait-seconds", type=int, help="give up after this long")
        else:
            sub.add_argument("--before", required=True, help="hour to stop at")
    job("compact").add_argument("--of", choices=["count", "rate"], required=True)
    for name in ("stream-count", "stream-rate"):
        sub = job(name, "source")
        sub.add_argument("--lateness", default=LATENESS, help="or 'none' to count all late events")
        sub.add_argument("--every", default="1 second", help="or 'once' to end when caught up")
        sub.add_argument("--wait-seconds", type=int, help="give up after this long")
        sub.add_argument("--day", help="only events whose DAY names this day")
        sub.add_argument("--final", action="store_true", help="write each day once, when it is over")
        sub.add_argument(
            "--max-files", type=int, help="files per micro-batch, if they arrive in event order"
        )
        sub.add_argument(
            "--compact-every", type=int, default=COMPACT_EVERY, help="batches, 0 for never"
        )
        sub.add_argument("--state-partitions", type=int, help="fixed by the first start")
    for name in ("daily-count", "stream-count"):
        jobs.choices[name].add_argument("--type", action="append", help="repeat for several")
    for name in ("daily-rate", "stream-rate"):
        jobs.choices[name].add_argument("--family", choices=PAIRS, required=True)
    return parser


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark.conf.set("spark.sql.session.timeZone", args.time_zone)
    types = tuple(getattr(args, "type", None) or (WALL_IMPRESSION,))

    if args.job.startswith("daily-"):
        read = {
            "grace_hours": args.grace_hours,
            "layout": LAYOUTS[args.layout],
            "allow_missing": args.allow_missing,
            "from_table": args.from_table,
        }
        where = (spark, args.source, args.target)
        if args.job == "daily-all":
            daily.write_days(*where, args.first, args.last, **read)
        elif args.job == "daily-count":
            seen = daily.write_daily_counts(
                *where, args.day, *types, by_label=args.by_label, **read
            )
            print(json.dumps(seen))
        else:
            pair = PAIRS[args.family]
            seen = daily.write_daily_rate(*where, args.day, pair, by_label=args.by_label, **read)
            print(json.dumps(seen))
    elif args.job == "count-change":
        insights.write_count_change(spark, args.source, args.target, args.day)
    elif args.job == "rate-change":
        insights.write_rate_change(spark, args.source, args.target, args.day)
    elif args.job == "store-landing":
        days = days_between(args.first, args.last)
        layout = LAYOUTS[args.layout]
        store_landing(spark, args.source, args.target, days, layout, args.allow_missing)
    elif args.job == "recount-late":
        hours = hours_between(args.first, args.before)
        found = hourly.recount_late(spark, args.source, args.target, hours, LAYOUTS[args.layout])
        print(json.dumps([hour.isoformat() for hour in found]))
    elif args.job == "hour-count":
        where = (spark, args.source, args.target)
        how = {
            "first": args.first,
            "close_after": args.close_after,
            "layout": LAYOUTS[args.layout],
        }
        if args.every == "once":
            print(json.dumps({"hours": hourly.catch_up(*where, **how)}))
        else:
            wait(hourly.start_hours(*where, args.every, **how), args.wait_seconds)
    elif args.job == "compact":
        fold = streams.compact_counts if args.of == "count" else streams.compact_rates
        fold(spark, args.target)
    else:
        lateness = None if args.lateness == "none" else args.lateness
        every = None if args.every == "once" else args.every
        where = (spark, args.source, args.target)
        how = {
            "lateness": lateness,
            "every": every,
            "final": args.final,
            "day": args.day,
            "max_files": args.max_files,
            "compact_every": args.compact_every,
        }
        with state_settings(spark, args.state_partitions):
            if args.job == "stream-count":
                query = streams.stream_daily_counts(*where, *types, **how)
            else:
                query = streams.stream_daily_rate(*where, PAIRS[args.family], **how)
        wait(query, args.wait_seconds)


if __name__ == "__main__":
    _parser().parse_args()  # a wrong argument is reported before a session is started
    run(SparkSession.builder.appName("adpulse").getOrCreate())
