"""The daily jobs: read a day's landing hours, measure, replace that day's output."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.days import Day, as_day
from adpulse.model import ALL_TYPES, GRACE_HOURS, POST, PRODUCT, Pair
from adpulse.operators.counts import event_counts
from adpulse.operators.rates import rate
from adpulse.operators.selection import on_day_label, on_days
from adpulse.plans.tables import COUNT_TABLE
from adpulse.sinks.daily import collection, overwrite_day, overwrite_range, read_days
from adpulse.sources.landing import (
    CORRUPT,
    PLAIN,
    Layout,
    read_landing,
    read_landing_days,
    read_landing_table,
    read_landing_table_days,
)


def day_events(
    spark: SparkSession,
    base: str,
    day: Day,
    grace_hours: int = GRACE_HOURS,
    layout: Layout = PLAIN,
    allow_missing: bool = False,
    by_label: bool = False,
    from_table: bool = False,
    seen: Observation | None = None,
) -> DataFrame:
    """Events of one day from its landing hours and the grace hours around them, from JSON
    directories or, with ``from_table``, from the landing table at ``base``.

    ``by_label`` goes by the ``DAY`` text of the event instead of its time text; such
    events belong to the day asked for, whatever date their time text shows. ``seen`` is told
    of all rows read, also of those that belong to no day.
    """
    if from_table:
        landed = read_landing_table(spark, base, day, grace_hours)
    else:
        keep = seen is not None
        landed = read_landing(spark, base, day, grace_hours, layout, allow_missing, keep)
    if seen is not None:
        corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in landed.columns else F.lit(False)
        landed = landed.observe(
            seen,
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("event_ts").isNull()).alias("without_time"),
            F.count_if(corrupt).alias("unparsable"),
        ).drop(CORRUPT)
    if by_label:
        return on_day_label(landed, day).withColumn("event_date", F.lit(as_day(day)))
    return on_days(landed, day)


EXCLUDED_RULES = "spark.sql.adaptive.optimizer.excludedRules"
EMPTY_RELATION = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


@contextmanager
def keeping_observations(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution replaces a plan whose result turns out empty, and what was observed in
    it is lost. Writes inside this keep it."""
    before = spark.conf.get(EXCLUDED_RULES, None)
    spark.conf.set(EXCLUDED_RULES, ",".join(filter(None, (before, EMPTY_RELATION))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(EXCLUDED_RULES)
        else:
            spark.conf.set(EXCLUDED_RULES, before)


def write_daily_counts(
    spark: SparkSession, base: str, target: str, day: Day, *types: str, **read
) -> dict[str, int]:
    """Returns the numbers of rows read, of those without a usable time and of those that are
    not JSON."""
    seen = Observation("arrivals")
    counts = event_counts(day_events(spark, base, day, seen=seen, **read), *types)
    with keeping_observations(spark):
        overwrite_day(counts, target, day, types)
    return seen.get


def write_daily_rate(
    spark: SparkSession, base: str, target: str, day: Day, pair: Pair, **read
) -> dict[str, int]:
    seen = Observation("arrivals")
    rates = rate(day_events(spark, base, day, seen=seen, **read), pair)
    with keeping_observations(spark):
        overwrite_day(rates, target, day)
    return seen.get


def write_days(
    spark: SparkSession,
    base: str,
    root: str,
    first: Day,
    last: Day,
    from_table: bool = False,
    grace_hours: int = GRACE_HOURS,
    **read,
) -> None:
    """All daily metrics of the days first..last from a single pass over their landing hours,
    or with ``from_table`` over the landing table.

    Counts of every type go to ``<root>/daily/counts``; both rates are computed from
    those and go to ``<root>/daily/product_rate`` and ``<root>/daily/post_rate``.
    """
    table = collection(root, "daily", "counts")
    if from_table:
        events = read_landing_table_days(spark, base, first, last, grace_hours)
    else:
        events = read_landing_days(spark, base, first, last, grace_hours, **read)
    overwrite_range(event_counts(events, *ALL_TYPES), table, first, last, ALL_TYPES)
    stored = read_days(spark, table, COUNT_TABLE, first, last)
    for name, pair in (("product_rate", PRODUCT), ("post_rate", POST)):
        target = collection(root, "daily", name)
        overwrite_range(rate(stored, pair, count="impressions"), target, first, last)
