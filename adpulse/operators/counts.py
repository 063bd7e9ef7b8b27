"""Grouped counts: one row per keys, event type and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.model import EVENT_SCHEMA, KEYS
from adpulse.operators.selection import of_type


def event_counts(events: DataFrame, *types: str, name: str = "impressions") -> DataFrame:
    """Count events of the given types per keys, type and event date.

    Partial aggregation runs before the one exchange, so a hot key costs one row per
    map task, not one per event.
    """
    return (
        of_type(events, *types)
        .groupBy(*KEYS, "EVENT_TYPE", "event_date")
        .agg(F.count("*").alias(name))
    )


def windowed_counts(events: DataFrame, *types: str, name: str = "impressions") -> DataFrame:
    """The same count over tumbling one-day windows of ``event_ts``."""
    return (
        of_type(events, *types)
        .groupBy(F.window("event_ts", "1 day"), *KEYS, "EVENT_TYPE")
        .agg(F.count("*").alias(name))
    )


def dropped_counts(recounted: DataFrame, streamed: DataFrame) -> DataFrame:
    """Events per keys, type and day that a stream dropped as too late: those a recount of
    the same files finds and the stream's present counts do not have.

    Exact, which the stream's own counter is not: that one counts rows after partial
    aggregation. The two tables are added up, not joined, so NULL keys need no care. Events
    without a usable time belong to no day, so no stream can be late for them;
    ``event_time_quality`` reports those.
    """
    group = [*KEYS, "EVENT_TYPE", "event_date"]
    dated = recounted.where(F.col("event_date").isNotNull())
    missing = dated.select(*group, F.col("impressions").alias("dropped")).unionByName(
        streamed.select(*group, (-F.col("impressions")).alias("dropped"))
    )
    return missing.groupBy(*group).agg(F.sum("dropped").alias("dropped")).where("dropped <> 0")


def event_time_quality(events: DataFrame) -> DataFrame:
    """Per event type: rows, rows whose time text is missing or malformed, and rows
    with a NULL key. Works on raw rows, before any of them can drop out of a window."""
    missing_key = F.lit(False)
    for key in KEYS:
        missing_key = missing_key | F.col(key).isNull()
    iso = EVENT_SCHEMA["ISOTIMESTAMP"].name
    return events.groupBy("EVENT_TYPE").agg(
        F.count("*").alias("events"),
        F.count_if(F.col(iso).isNull()).alias("missing_time"),
        F.count_if(F.col(iso).isNotNull() & F.col("event_ts").isNull()).alias("malformed_time"),
        F.count_if(missing_key).alias("null_key"),
    )
