"""The comparison jobs: two stored days in, one day of changes out.

They start from what the daily jobs stored, so the events are not scanned again.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from adpulse.functions.days import Day, shift
from adpulse.operators.changes import compare_rates, count_change
from adpulse.plans.tables import COUNT_TABLE, RATE_TABLE
from adpulse.sinks.catalog import read_table, replace_table
from adpulse.sinks.daily import overwrite_day, read_days


def write_rate_change(spark: SparkSession, rates: str, target: str, day: Day) -> None:
    stored = read_days(spark, rates, RATE_TABLE, shift(day, -1), day)
    overwrite_day(compare_rates(stored, day), target, day)


def write_count_change(spark: SparkSession, counts: str, target: str, day: Day) -> None:
    stored = read_days(spark, counts, COUNT_TABLE, shift(day, -1), day)
    overwrite_day(count_change(stored, day, count="impressions"), target, day)


def replace_rate_change(
    spark: SparkSession, database: str, rates: str, target: str, day: Day
) -> None:
    """``write_rate_change`` between named tables. If the rates are laid out by key, no row of them
    is moved to be compared."""
    replace_table(compare_rates(read_table(spark, database, rates), day), database, target)


def replace_count_change(
    spark: SparkSession, database: str, counts: str, target: str, day: Day
) -> None:
    stored = read_table(spark, database, counts)
    replace_table(count_change(stored, day, count="impressions"), database, target)
