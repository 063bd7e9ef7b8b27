"""Day-over-day change.

Rates keep every key seen on either day, NULL keys included. Counts keep only the
groups present on both days with every key set. The two rules differ on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.functions.days import Day, as_day, shift
from adpulse.functions.measures import percent_change, ratio, rows_where
from adpulse.model import KEYS, Pair
from adpulse.operators.counts import event_counts
from adpulse.operators.rates import RATE, rate
from adpulse.operators.selection import of_type, on_days, with_all_keys


def _with_change(compared: DataFrame) -> DataFrame:
    return compared.withColumn("pct_change", percent_change(F.col("current"), F.col("previous")))


def rate_change(events: DataFrame, pair: Pair, day: Day) -> DataFrame:
    """Change of the rate from the day before to this day: one scan, one exchange."""
    kind, date = F.col("EVENT_TYPE"), F.col("event_date")

    def rate_on(when: Day):
        return ratio(
            rows_where((kind == pair.impression) & (date == F.lit(as_day(when)))),
            rows_where((kind == pair.click) & (date == F.lit(as_day(when)))),
        )

    two_days = on_days(of_type(events, *pair.types), shift(day, -1), day)
    return _with_change(
        two_days.groupBy(*KEYS).agg(
            rate_on(shift(day, -1)).alias("previous"), rate_on(day).alias("current")
        )
    ).withColumn("event_date", F.lit(as_day(day)))


def count_change(
    events: DataFrame, day: Day, *types: str, count: str | None = None
) -> DataFrame:
    """Change of the count per keys and type, for groups present on both days.

    Without types, of every type there is. With ``count``, the rows are stored counts and
    that column holds them; two day partitions of the table are read.
    """
    date = F.col("event_date")
    wanted = of_type(events, *types) if types else events
    both = (
        on_days(with_all_keys(wanted), shift(day, -1), day)
        .groupBy(*KEYS, "EVENT_TYPE")
        .agg(
            rows_where(date == F.lit(shift(day, -1)), count).alias("previous"),
            rows_where(date == F.lit(as_day(day)), count).alias("current"),
        )
        .where(F.col("previous").isNotNull() & F.col("current").isNotNull())
    )
    return _with_change(both).withColumn("event_date", F.lit(as_day(day)))


def compare_rates(rates: DataFrame, day: Day) -> DataFrame:
    """``rate_change`` from a stored rate table: reads two of its day partitions."""
    date = F.col("event_date")
    return _with_change(
        on_days(rates, shift(day, -1), day)
        .groupBy(*KEYS)
        .agg(
            F.sum(F.when(date == F.lit(shift(day, -1)), F.col(RATE))).alias("previous"),
            F.sum(F.when(date == F.lit(as_day(day)), F.col(RATE))).alias("current"),
        )
    ).withColumn("event_date", F.lit(as_day(day)))


def join_days(previous: DataFrame, current: DataFrame, how: str = "full") -> DataFrame:
    """Pair two days of a metric on the keys alone, as an equality join does.

    Reduce each day to one row per key first: two rows per key on both sides would
    multiply each other.
    """
    return previous.join(current, list(KEYS), how)


def regroup(joined: DataFrame) -> DataFrame:
    """One row per keys again, NULL keys included, from the halves of ``join_days``, with the
    percent change."""
    return _with_change(
        joined.groupBy(*KEYS).agg(
            F.sum("previous").alias("previous"), F.sum("current").alias("current")
        )
    )


def _shifted(daily: DataFrame, group: tuple[str, ...], value: str, first: Day, last: Day):
    """Each daily row serves as the current value of its day and the previous value of
    the next. Works on rows that are already one per group and day."""
    missing = F.lit(None).cast(daily.schema[value].dataType)
    sides = F.inline(
        F.array(
            F.struct(
                F.col("event_date"), F.col(value).alias("current"), missing.alias("previous")
            ),
            F.struct(
                F.date_add("event_date", 1).alias("event_date"),
                missing.alias("current"),
                F.col(value).alias("previous"),
            ),
        )
    )
    return (
        on_days(daily.select(*group, sides), first, last)
        .groupBy(*group, "event_date")
        .agg(F.sum("current").alias("current"), F.sum("previous").alias("previous"))
    )


def rate_changes(events: DataFrame, pair: Pair, first: Day, last: Day) -> DataFrame:
    """``rate_change`` for every day from first to last, in one scan."""
    daily = rate(on_days(events, shift(first, -1), last), pair)
    return _with_change(_shifted(daily, KEYS, RATE, first, last))


def count_changes(events: DataFrame, first: Day, last: Day, *types: str) -> DataFrame:
    """``count_change`` for every day from first to last, in one scan."""
    daily = event_counts(with_all_keys(on_days(events, shift(first, -1), last)), *types)
    both = _shifted(daily, (*KEYS, "EVENT_TYPE"), "impressions", first, last).where(
        F.col("previous").isNotNull() & F.col("current").isNotNull()
    )
    return _with_change(both)
