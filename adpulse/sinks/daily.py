"""Metric tables partitioned by day, count tables by day and event type.

Writing a day again replaces that day and nothing else, so a rerun does not duplicate
rows and one job cannot wipe another day. In a count table it replaces the types written, so
jobs for several types can share one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adpulse.functions.days import Day, as_day, days_between
from adpulse.sinks.files import a_file_of_each, exists, remove, rename


def overwrite_days(
    rows: DataFrame,
    path: str,
    days: list[Day],
    by: str = "event_date",
    then_by: tuple[str, ...] = (),
    rebalance: bool = True,
    types: tuple[str, ...] | None = None,
) -> None:
    """Replace the given days of a Parquet table with those days of ``rows``; with ``types``,
    exactly those types of the days, in a table partitioned by ``EVENT_TYPE`` below the day.

    Dynamic partition overwrite stages the new files and swaps them in at commit, so a
    failed job leaves the old day in place. It does not touch a partition that got no
    rows. Such a partition still has the file it had before, and is then removed.

    ``rebalance`` lets adaptive execution give each day files of a sensible size: small
    days share a task, a large one is split over several.
    """
    wanted = [as_day(day) for day in days]
    replaced = [f"{by}={day.isoformat()}" for day in wanted]
    chosen = rows.where(F.col(by).isin(wanted))
    if types is not None:
        replaced = [f"{day}/EVENT_TYPE={kind}" for day in replaced for kind in types]
        chosen = chosen.where(F.col("EVENT_TYPE").isin(*types))
        then_by = ("EVENT_TYPE", *then_by)
    if rebalance:
        chosen = chosen.hint("rebalance", by, *then_by)
    _swap(chosen, path, replaced, (by, *then_by))


def _swap(rows: DataFrame, path: str, replaced: list[str], by: tuple[str, ...]) -> None:
    """Write the partitions ``replaced``, and remove those of them that got no rows."""
    spark = rows.sparkSession
    before: dict[str, str] = {}
    for partition in replaced:
        before.update(a_file_of_each(spark, f"{path.rstrip('/')}/{partition}"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    for partition, file in before.items():
        if exists(spark, file):
            remove(spark, partition)


def overwrite_hours(rows: DataFrame, path: str, hours: list[dt.datetime]) -> None:
    """Replace the given hours of a Parquet table by ``landing_date`` and ``landing_hour`` with
    ``rows``, which are of those hours alone. Other hours of their days stay."""
    by = ("landing_date", "landing_hour")
    replaced = [
        f"landing_date={hour.date().isoformat()}/landing_hour={hour.hour}" for hour in hours
    ]
    _swap(rows.hint("rebalance", *by), path, replaced, by)


def overwrite_day(
    rows: DataFrame, path: str, day: Day, types: tuple[str, ...] | None = None
) -> None:
    overwrite_days(rows, path, [day], types=types)


def overwrite_range(
    rows: DataFrame, path: str, first: Day, last: Day, types: tuple[str, ...] | None = None
) -> None:
    overwrite_days(rows, path, days_between(first, last), types=types)


def partitions_of(rows: DataFrame) -> tuple[str, ...]:
    return ("event_date", "EVENT_TYPE") if "EVENT_TYPE" in rows.columns else ("event_date",)


def replace_all(rows: DataFrame, path: str) -> None:
    """Replace the whole table, every day of it. The new one is written beside it and takes its
    place when it is complete; if that fails, the old rows stay."""
    spark, by = rows.sparkSession, partitions_of(rows)
    path = path.rstrip("/")
    new, old = f"{path}.next", f"{path}.previous"
    if not exists(spark, path) and exists(spark, old):  # ended between its two renames
        rename(spark, old, path)
    rows.hint("rebalance", *by).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(*by).parquet(new)
    remove(spark, old)
    if exists(spark, path):
        rename(spark, path, old)
    rename(spark, new, path)
    remove(spark, old)


def append(rows: DataFrame, path: str) -> None:
    """Add rows without looking at what is there. A rerun adds them a second time."""
    by = partitions_of(rows)
    rows.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)


def collection(root: str, database: str, name: str) -> str:
    """Location of a named table below a database directory."""
    return f"{root.rstrip('/')}/{database}/{name}"


def read_days(
    spark: SparkSession,
    path: str,
    schema: StructType,
    first: Day | None = None,
    last: Day | None = None,
) -> DataFrame:
    """The stored days from first to last; the other partitions are not read."""
    rows = spark.read.schema(schema).parquet(path).select(*schema.names)
    if first is not None:
        rows = rows.where(F.col("event_date") >= F.lit(as_day(first)))
    if last is not None:
        rows = rows.where(F.col("event_date") <= F.lit(as_day(last)))
    return rows
