"""The daily metrics over an event stream.

The watermark, the window and the output key all use ``event_ts``, so late events are
dropped and finished days leave the state. With ``lateness=None`` there is no watermark:
any late event is counted and every day stays in the state for good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.functions.event_time import utc_day
from adpulse.functions.measures import rows_where
from adpulse.model import KEYS, LATENESS, Pair
from adpulse.operators.counts import windowed_counts
from adpulse.operators.rates import with_rate
from adpulse.operators.selection import of_type


def _watermarked(events: DataFrame, lateness: str | None) -> DataFrame:
    return events.withWatermark("event_ts", lateness) if lateness else events


def with_window_day(windowed: DataFrame) -> DataFrame:
    return windowed.withColumn("event_date", utc_day(F.col("window.start")))


def daily_counts(
    events: DataFrame, *types: str, lateness: str | None = LATENESS, name: str = "impressions"
) -> DataFrame:
    """Count per one-day window, keys and type."""
    selected = _watermarked(of_type(events, *types), lateness)
    return with_window_day(windowed_counts(selected, *types, name=name))


def daily_rate(events: DataFrame, pair: Pair, lateness: str | None = LATENESS) -> DataFrame:
    """Impressions per click per one-day window and keys, as one aggregation.

    Two aggregations joined would need a second and third copy of the state and cannot
    run in update mode at all.
    """
    kind = F.col("EVENT_TYPE")
    return with_rate(
        with_window_day(
            _watermarked(of_type(events, *pair.types), lateness)
            .groupBy(F.window("event_ts", "1 day"), *KEYS)
            .agg(
                rows_where(kind == pair.impression).alias("impressions"),
                rows_where(kind == pair.click).alias("clicks"),
            )
        )
    )


def joined_daily_rate(events: DataFrame, pair: Pair, lateness: str = LATENESS) -> DataFrame:
    """The rate as a full join of two streaming counts, for append mode.

    Each finished day is emitted once, as counts; the reader computes the rate with
    ``operators.rates.regroup``. That also sums the halves of a group with a NULL key,
    whether or not the join has paired them. ``daily_rate`` needs less state and also
    shows the days still running.
    """
    watermarked = _watermarked(of_type(events, *pair.types), lateness)
    impressions, clicks = (
        windowed_counts(watermarked, kind, name=name).drop("EVENT_TYPE")
        for kind, name in ((pair.impression, "impressions"), (pair.click, "clicks"))
    )
    return with_window_day(impressions.join(clicks, ["window", *KEYS], "full"))
