"""Counts per landing hour, merged when they are read.

Every landing hour has its own partial counts, so a file that arrives late costs a recount of its
hour and not of the days around it. A day's counts are the sums over the hours it is read from: its
own and the grace hours around them, or all there are.

A step takes the open hours in order, counts those whose files have changed in one scan, replaces
their partial counts, records their files and closes the hours that are long enough over. Steps can
be repeated at any point: an hour that was counted but not recorded is counted again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from adpulse.functions.days import Day, shift
from adpulse.functions.event_time import with_event_time
from adpulse.functions.hours import HOUR, Hour, as_hour, hours_between, this_hour
from adpulse.model import ALL_TYPES, GRACE_HOURS, KEYS
from adpulse.operators.selection import of_type, on_days
from adpulse.plans.tables import COUNT_TABLE
from adpulse.sinks.daily import overwrite_hours
from adpulse.sources.landing import PLAIN, Layout, in_landing_span, read_landing_files
from adpulse.sources.ledger import (
    File,
    changed,
    close_before,
    first_open,
    late_files,
    record,
)

#: Hours after its end at which an hour is closed.
CLOSE_AFTER = 2
#: Hours that one step takes.
MAX_HOURS = 7 * 24

PARTIAL_COUNTS = StructType(
    [*COUNT_TABLE, StructField("landing_date", DateType()), StructField("landing_hour", IntegerType())]
)


def counts_at(target: str) -> str:
    return f"{target.rstrip('/')}/counts"


def ledger_at(target: str) -> str:
    return f"{target.rstrip('/')}/ledger"


def _count(
    spark: SparkSession, base: str, target: str, hours: dict[Hour, set[File]], layout: Layout
) -> None:
    paths = sorted(file.path for files in hours.values() for file in files)
    if paths:
        events = with_event_time(read_landing_files(spark, base, paths, layout))
        group = [*KEYS, "EVENT_TYPE", "event_date", "landing_date", "landing_hour"]
        counts = of_type(events, *ALL_TYPES).groupBy(*group).agg(F.count("*").alias("impressions"))
    else:
        counts = spark.createDataFrame([], PARTIAL_COUNTS)
    overwrite_hours(counts, counts_at(target), list(hours))
    record(spark, ledger_at(target), hours)


def step(
    spark: SparkSession,
    base: str,
    target: str,
    first: Hour | Day | None = None,
    now: Hour | None = None,
    close_after: int = CLOSE_AFTER,
    max_hours: int = MAX_HOURS,
    layout: Layout = PLAIN,
) -> list[Hour]:
    """Count the open hours, ``max_hours`` of them at most, that have changed. Returns those hours.
    ``first`` is the hour to start with if none was closed before; ``now`` the present one."""
    now = this_hour() if now is None else as_hour(now)
    start = first_open(spark, ledger_at(target))
    if start is None:
        if first is None:
            raise ValueError("the first step needs an hour to start with")
        start = as_hour(first)
    end = min(now + HOUR, start + max_hours * HOUR)
    new = changed(spark, base, ledger_at(target), hours_between(start, end), layout)
    if new:
        _count(spark, base, target, new, layout)
    over = min(end, now - close_after * HOUR)
    if over > start:
        close_before(spark, ledger_at(target), over)
    return sorted(new)


def catch_up(spark: SparkSession, base: str, target: str, now: Hour | None = None, **how) -> int:
    """Steps until no hour is left to close. Returns the number of hours counted."""
    now = this_hour() if now is None else as_hour(now)
    counted, before = 0, None
    while True:
        counted += len(step(spark, base, target, now=now, **how))
        offset = first_open(spark, ledger_at(target))
        if offset is None or offset == before:
            return counted
        before = offset


def start_hours(
    spark: SparkSession, base: str, target: str, every: str = "1 minute", **how
) -> StreamingQuery:
    """A stream that takes a step at every trigger and is stopped like any other. It has no state
    but the ledger, so it can be started anew at any time."""

    def on_trigger(_: DataFrame, __: int) -> None:
        step(spark, base, target, **how)

    return (
        spark.readStream.format("rate").load()
        .writeStream.foreachBatch(on_trigger)
        .trigger(processingTime=every)
        .start()
    )


def recount(
    spark: SparkSession, base: str, target: str, hours: list[Hour], layout: Layout = PLAIN
) -> list[Hour]:
    """Count those of the given hours again whose files have changed, closed ones too."""
    new = changed(spark, base, ledger_at(target), hours, layout)
    if new:
        _count(spark, base, target, new, layout)
    return sorted(new)


def recount_late(
    spark: SparkSession, base: str, target: str, hours: list[Hour], layout: Layout = PLAIN
) -> list[Hour]:
    """Find late files in the closed ones of these hours and count their hours again."""
    late = late_files(spark, base, ledger_at(target), hours, layout)
    rows = late.select("landing_date", "landing_hour").distinct().toLocalIterator()
    found = [as_hour(row["landing_date"]).replace(hour=row["landing_hour"]) for row in rows]
    return recount(spark, base, target, sorted(found), layout)


def merged_counts(
    spark: SparkSession,
    target: str,
    *types: str,
    first: Day | None = None,
    last: Day | None = None,
    grace_hours: int | None = GRACE_HOURS,
) -> DataFrame:
    """The counts of the days first..last, or of all, as ``event_counts`` gives them for events that
    landed within the grace hours around their day; with None, whenever they landed."""
    rows = spark.read.schema(PARTIAL_COUNTS).parquet(counts_at(target))
    if types:
        rows = of_type(rows, *types)
    if first is not None:
        rows = on_days(rows, first, last)
    if grace_hours is not None:
        if first is not None:
            landed = (shift(first, -1), shift(first if last is None else last, 1))
            rows = rows.where(F.col("landing_date").between(*map(F.lit, landed)))
        rows = rows.where(in_landing_span(F.col("event_date"), grace_hours))
    group = [*KEYS, "EVENT_TYPE", "event_date"]
    return rows.groupBy(*group).agg(F.sum("impressions").alias("impressions"))


def late_events(
    spark: SparkSession, base: str, target: str, hours: list[Hour], layout: Layout = PLAIN
) -> DataFrame:
    """``landing_date, landing_hour, files, events``: what lies in closed hours uncounted."""
    late = late_files(spark, base, ledger_at(target), hours, layout)
    paths = [row["path"] for row in late.select("path").toLocalIterator()]
    by = ["landing_date", "landing_hour"]
    files = late.groupBy(*by).agg(F.count("*").alias("files"))
    if not paths:
        return files.withColumn("events", F.lit(0).cast("long"))
    rows = read_landing_files(spark, base, paths, layout).groupBy(*by).agg(F.count("*").alias("events"))
    return files.join(rows, by, "left").select(*by, "files", F.coalesce("events", F.lit(0)).alias("events"))
