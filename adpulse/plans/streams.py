"""The streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from adpulse.functions.days import Day
from adpulse.model import KEYS, LATENESS, Pair
from adpulse.operators.rates import RATE, regroup
from adpulse.operators.selection import on_day_label, on_days
from adpulse.plans.tables import COUNT_LOG, RATE_LOG
from adpulse.sources.streams import count_arrivals, stream_events
from adpulse.streaming.aggregates import daily_counts, daily_rate, joined_daily_rate
from adpulse.streaming.changelog import COMPACT_EVERY, compact, latest, read_changes
from adpulse.streaming.runs import FINAL_DAYS, start_finals, start_upserts

# The window belongs to the key: as a value it would be a struct to aggregate.
RATE_KEY = ("window", "event_date", *KEYS)
COUNT_KEY = (*RATE_KEY, "EVENT_TYPE")


def _arrivals(
    spark: SparkSession, source: str, day: Day | None, max_files: int | None
) -> DataFrame:
    events = count_arrivals(stream_events(spark, source, max_files))
    return events if day is None else on_day_label(events, day)


def stream_daily_counts(
    spark: SparkSession,
    source: str,
    target: str,
    *types: str,
    lateness: str | None = LATENESS,
    every: str | None = "1 second",
    final: bool = False,
    day: Day | None = None,
    max_files: int | None = None,
    compact_every: int | None = COMPACT_EVERY,
) -> StreamingQuery:
    """Running counts as upserts, or each day once when ``final``. With ``day``, only of
    events whose ``DAY`` text names it."""
    arrivals = _arrivals(spark, source, day, max_files)
    counts = daily_counts(arrivals, *types, lateness=lateness)
    if final:
        return start_finals(counts, target, every)
    return start_upserts(counts, target, every, compact_every, COUNT_KEY)


def stream_daily_rate(
    spark: SparkSession,
    source: str,
    target: str,
    pair: Pair,
    lateness: str | None = LATENESS,
    every: str | None = "1 second",
    day: Day | None = None,
    final: bool = False,
    max_files: int | None = None,
    compact_every: int | None = COMPACT_EVERY,
) -> StreamingQuery:
    """Running rates as upserts, or each day's two counts once when ``final``, which needs a
    ``lateness``; ``final_rates`` reads those."""
    arrivals = _arrivals(spark, source, day, max_files)
    if final:
        if lateness is None:
            raise ValueError("a final rate needs a lateness, or no day is ever over")
        return start_finals(joined_daily_rate(arrivals, pair, lateness), target, every)
    result = daily_rate(arrivals, pair, lateness)
    return start_upserts(result, target, every, compact_every, RATE_KEY)


def _changes(
    spark: SparkSession,
    target: str,
    columns: StructType,
    first: Day | None,
    last: Day | None,
) -> DataFrame:
    """Only the days asked for are read: each has partitions of its own."""
    changes = read_changes(spark, target, columns)
    return changes if first is None else on_days(changes, first, last)


def current_counts(
    spark: SparkSession, target: str, first: Day | None = None, last: Day | None = None
) -> DataFrame:
    """The present value of every group ``stream_daily_counts`` has written, of all days, of one
    or of those from first to last."""
    return latest(_changes(spark, target, COUNT_LOG, first, last), COUNT_KEY)


def current_rates(
    spark: SparkSession, target: str, first: Day | None = None, last: Day | None = None
) -> DataFrame:
    """The present value of every group ``stream_daily_rate`` has written."""
    return latest(_changes(spark, target, RATE_LOG, first, last), RATE_KEY)


def final_rates(spark: SparkSession, target: str) -> DataFrame:
    """The rates of the finished days a ``final`` rate stream has written."""
    halves = StructType([field for field in RATE_LOG if field.name != RATE])
    return regroup(spark.read.schema(halves).parquet(f"{target}/{FINAL_DAYS}"))


def final_counts(spark: SparkSession, target: str) -> DataFrame:
    """The finished days a ``final`` stream has written."""
    return spark.read.schema(COUNT_LOG).parquet(f"{target}/{FINAL_DAYS}")


def compact_counts(spark: SparkSession, target: str) -> None:
    compact(spark, target, COUNT_LOG, COUNT_KEY)


def compact_rates(spark: SparkSession, target: str) -> None:
    compact(spark, target, RATE_LOG, RATE_KEY)
