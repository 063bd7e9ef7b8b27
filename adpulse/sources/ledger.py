"""Which landing hours are closed, and which files each hour held when it was read.

A source that remembers every file it has seen lists everything at every trigger, and what it
remembers grows for as long as it runs. Here the offset is an hour: all hours before it are closed
and are not listed again. Hours from it on are open; an open hour is read again when its files are
no longer those recorded for it.

``offset`` holds one directory, named by the number of the first open hour. ``files`` has a row per
file of every hour read, partitioned by landing date and hour. Recording an hour replaces it, so a
run that failed on the way can be repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.hours import Hour, as_hour, hour_number, numbered_hour
from adpulse.sinks.daily import overwrite_hours
from adpulse.sinks.files import make_dir, numbered_dirs, remove
from adpulse.sources.landing import PLAIN, Layout, hour_of_path, paths_of

FILES = "path string, length long, modified timestamp, landing_date date, landing_hour int"
FILE = ("path", "length", "modified")


class File(NamedTuple):
    """A file as listed. A file that was written again is another one."""

    path: str
    length: int
    modified: dt.datetime


def first_open(spark: SparkSession, ledger: str) -> Hour | None:
    """The first hour that is not closed; None before anything was."""
    numbers = numbered_dirs(spark, f"{ledger}/offset", "hour")
    return numbered_hour(numbers[-1]) if numbers else None


def close_before(spark: SparkSession, ledger: str, hour: Hour) -> None:
    """Close all hours before this one. The offset never goes back."""
    number = hour_number(hour)
    older = numbered_dirs(spark, f"{ledger}/offset", "hour")
    if older and older[-1] >= number:
        return
    make_dir(spark, f"{ledger}/offset/hour={number}")
    for before in older:
        remove(spark, f"{ledger}/offset/hour={before}")


def listed(
    spark: SparkSession, base: str, hours: Iterable[Hour], layout: Layout = PLAIN
) -> DataFrame:
    """The files that lie in these hours now, without opening any. Hours that have no directory
    have no files."""
    dirs = [layout.hour_dir(hour.date(), hour.hour) for hour in hours]
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = reader.load(paths_of(base, dirs, allow_missing=True))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES)
    date, hour = hour_of_path(F.col("path"), layout)
    return files.select(
        "path",
        "length",
        F.col("modificationTime").alias("modified"),
        date.alias("landing_date"),
        hour.alias("landing_hour"),
    )


def recorded(spark: SparkSession, ledger: str, hours: Iterable[Hour]) -> DataFrame:
    """The files recorded for these hours; other hours are not read."""
    days = sorted({hour.date() for hour in hours})
    try:
        rows = spark.read.schema(FILES).parquet(f"{ledger}/files")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES)
    return rows.where(F.col("landing_date").isin(days)) if days else rows.where("false")


def _by_hour(files: DataFrame) -> dict[Hour, set[File]]:
    found: dict[Hour, set[File]] = {}
    for row in files.toLocalIterator():
        hour = as_hour(row["landing_date"]).replace(hour=row["landing_hour"])
        found.setdefault(hour, set()).add(File(*(row[name] for name in FILE)))
    return found


def changed(
    spark: SparkSession, base: str, ledger: str, hours: list[Hour], layout: Layout = PLAIN
) -> dict[Hour, set[File]]:
    """Those of the hours whose files are not the recorded ones, with their files now. The files of
    these hours, and of no others, pass through the driver, as they do in any listing."""
    if not hours:
        return {}
    now, before = (
        _by_hour(files)
        for files in (listed(spark, base, hours, layout), recorded(spark, ledger, hours))
    )
    nothing: set[File] = set()
    return {
        hour: now.get(hour, nothing)
        for hour in hours
        if now.get(hour, nothing) != before.get(hour, nothing)
    }


def record(spark: SparkSession, ledger: str, hours: dict[Hour, set[File]]) -> None:
    """Replace what is recorded for these hours."""
    rows = [
        (*file, hour.date(), hour.hour) for hour, files in hours.items() for file in sorted(files)
    ]
    overwrite_hours(spark.createDataFrame(rows, FILES), f"{ledger}/files", list(hours))


def late_files(
    spark: SparkSession, base: str, ledger: str, hours: list[Hour], layout: Layout = PLAIN
) -> DataFrame:
    """Files that lie in closed hours and are not recorded for them: what arrived, or was written
    again, after its hour was closed. The audit lists the hours it is asked about."""
    offset = first_open(spark, ledger)
    closed = [hour for hour in hours if offset is not None and hour < offset]
    if not closed:
        return spark.createDataFrame([], FILES)
    known = recorded(spark, ledger, closed)
    return listed(spark, base, closed, layout).join(known, [*FILE, "landing_date", "landing_hour"], "left_anti")
