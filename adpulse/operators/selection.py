"""Row selections. All of them are plain comparisons that reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.functions.days import Day, as_day
from adpulse.model import KEYS


def of_type(events: DataFrame, *types: str) -> DataFrame:
    return events.where(F.col("EVENT_TYPE").isin(*types))


def on_days(events: DataFrame, first: Day, last: Day | None = None) -> DataFrame:
    """Events whose own date lies in first..last; one day when last is left out."""
    if last is None:
        return events.where(F.col("event_date") == F.lit(as_day(first)))
    return events.where(F.col("event_date").between(F.lit(as_day(first)), F.lit(as_day(last))))


def on_day_label(events: DataFrame, day: Day) -> DataFrame:
    """Events whose ``DAY`` text names this day of the month, padded or not.

    The label has no month, so use it only on a read that spans less than one.
    """
    number = as_day(day).day
    return events.where(F.col("DAY").isin(f"{number:02d}", str(number)))


def with_all_keys(events: DataFrame) -> DataFrame:
    """Drop rows with a NULL key: an equality join would never match them."""
    for key in KEYS:
        events = events.where(F.col(key).isNotNull())
    return events
