"""Event time from ISO text.

``try_cast`` turns malformed text into NULL; under ANSI mode a plain cast would
fail the whole job on one bad row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_timestamp(text: Column) -> Column:
    """The instant; text without an offset is read in the session time zone."""
    return text.try_cast("timestamp")


def with_event_time(events: DataFrame) -> DataFrame:
    """Add ``event_ts`` and ``event_date``, its UTC day: the day the streams' windows have too.
    The unused one is pruned from the plan. The day written in the text is ``DAY``."""
    instant = parse_timestamp(F.col("ISOTIMESTAMP"))
    return events.withColumns({"event_ts": instant, "event_date": utc_day(instant)})


def utc_day(ts: Column) -> Column:
    """UTC day of an instant. Day windows are cut at UTC midnight, so a plain cast,
    which follows the session zone, could name the neighbouring day."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int"))
