"""Landing directories: JSON lines filed under the hour in which they arrived.

The directory says when a file landed, the row says when the event happened. A daily
job therefore reads its day plus the neighbouring grace hours and then selects rows by
their own date.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from adpulse.functions.days import Day, as_day, days_between, shift
from adpulse.functions.event_time import with_event_time
from adpulse.model import EVENT_SCHEMA, GRACE_HOURS
from adpulse.operators.selection import on_days
from adpulse.sinks.daily import overwrite_days

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Layout:
    """How day and hour directories are named. Those of a partitioned layout are partition
    columns, which Spark prunes."""

    day: str
    hour: str
    partitioned: bool = False

    def day_dir(self, day: Day) -> str:
        return as_day(day).strftime(self.day)

    def hour_dir(self, day: Day, hour: int) -> str:
        return f"{self.day_dir(day)}/{self.hour.format(hour)}"


# year/month/day/hour directories, and the same as partition directories.
PLAIN = Layout("%Y/%m/%d", "{:02d}")
PARTITIONED = Layout("landing_date=%Y-%m-%d", "landing_hour={:02d}", partitioned=True)
LANDING_COLUMNS = [
    StructField("landing_date", DateType()),
    StructField("landing_hour", IntegerType()),
]


def landing_dirs(
    first: Day, last: Day | None = None, grace_hours: int = GRACE_HOURS, layout: Layout = PLAIN
) -> list[str]:
    """Directories to read for the days first..last (one day when last is left out): all
    their hours, the last hours of the day before, the first hours of the day after."""
    if not 0 <= grace_hours <= 24:
        raise ValueError("grace_hours must be between 0 and 24")
    days = days_between(first, first if last is None else last)
    before = [layout.hour_dir(shift(days[0], -1), h) for h in range(24 - grace_hours, 24)]
    after = [layout.hour_dir(shift(days[-1], 1), h) for h in range(grace_hours)]
    return [*before, *map(layout.day_dir, days), *after]


def read_json(
    spark: SparkSession,
    paths: list[str] | str,
    keep_malformed: bool = False,
    partitioned_below: str | None = None,
) -> DataFrame:
    """JSON lines under the agreed schema, never inferred.

    Inference would scan the input once more and make the columns depend on which files
    are there. A line that is not JSON becomes a row of NULLs; with ``keep_malformed``
    its text is kept in ``_corrupt_record``. Directories are read with all below them,
    so one path stands for all hours of a day and listing stays cheap. Below the directory
    ``partitioned_below``, landing date and hour are partition columns of the rows.
    """
    fields = list(EVENT_SCHEMA)
    if keep_malformed:
        fields.append(StructField(CORRUPT, StringType()))
    reader = spark.read.option("mode", "PERMISSIVE")
    if partitioned_below is not None:
        schema = StructType([*fields, *LANDING_COLUMNS])
        return reader.schema(schema).option("basePath", partitioned_below).json(paths)
    return reader.schema(StructType(fields)).option("recursiveFileLookup", "true").json(paths)


def paths_of(base: str, dirs: list[str], allow_missing: bool) -> list[str]:
    """A missing directory fails the read, so a late feed is not mistaken for a quiet one.
    ``allow_missing`` names all of them in one glob, which needs only one to exist."""
    if allow_missing:
        return [f"{base.rstrip('/')}/{{{','.join(dirs)}}}"]
    return [f"{base.rstrip('/')}/{name}" for name in dirs]


def hour_of_path(path: Column, layout: Layout = PLAIN) -> tuple[Column, Column]:
    """Landing date and hour of a file."""
    parts = F.split(path, "/")
    if layout.partitioned:
        day, hour = (F.substring_index(F.element_at(parts, n), "=", -1) for n in (-3, -2))
        return day.cast("date"), hour.cast("int")
    year, month, day, hour = (F.element_at(parts, n) for n in range(-5, -1))
    return F.concat_ws("-", year, month, day).cast("date"), hour.cast("int")


def _with_landing_hour(
    spark: SparkSession, base: str, paths: list[str] | str, layout: Layout
) -> DataFrame:
    """The rows with the date and hour of the directory each was read from. A path that does
    not have the layout fails the job: its rows would belong to no day."""
    if layout.partitioned:
        return read_json(spark, paths, partitioned_below=base)
    date, hour = hour_of_path(F.col("_metadata.file_path"), layout)
    return read_json(spark, paths).withColumns({"landing_date": date, "landing_hour": hour})


def read_landing(
    spark: SparkSession,
    base: str,
    day: Day,
    grace_hours: int = GRACE_HOURS,
    layout: Layout = PLAIN,
    allow_missing: bool = False,
    keep_malformed: bool = False,
) -> DataFrame:
    """One day's landing directories with their grace hours, as a single scan."""
    dirs = landing_dirs(day, None, grace_hours, layout)
    return with_event_time(read_json(spark, paths_of(base, dirs, allow_missing), keep_malformed))


def read_landing_days(
    spark: SparkSession,
    base: str,
    first: Day,
    last: Day,
    grace_hours: int = GRACE_HOURS,
    layout: Layout = PLAIN,
    allow_missing: bool = False,
) -> DataFrame:
    """Events of the days first..last in one scan, each of them landed within the grace
    hours around its own day: what ``read_landing`` day by day would keep."""
    dirs = landing_dirs(first, last, grace_hours, layout)
    rows = _with_landing_hour(spark, base, paths_of(base, dirs, allow_missing), layout)
    events = with_event_time(rows)
    in_time = in_landing_span(F.col("event_date"), grace_hours)
    return on_days(events, first, last).where(in_time)


def read_landing_files(
    spark: SparkSession, base: str, files: list[str], layout: Layout = PLAIN
) -> DataFrame:
    """The files named, each row with the date and hour of its directory."""
    return _with_landing_hour(spark, base, files, layout)


def read_landing_hours(
    spark: SparkSession,
    base: str,
    days: list[Day] | None = None,
    layout: Layout = PLAIN,
    allow_missing: bool = False,
) -> DataFrame:
    """Whole landing days, or all there are, each row with the date and hour of its
    directory."""
    dirs = None if days is None else [layout.day_dir(day) for day in days]
    paths = base if dirs is None else paths_of(base, dirs, allow_missing)
    return _with_landing_hour(spark, base, paths, layout)


# Events as kept in the landing table: typed time columns beside the original text, so
# that date and type selections are answered from Parquet statistics.
LANDING_TABLE_SCHEMA = StructType(
    [
        *EVENT_SCHEMA,
        StructField("event_ts", TimestampType()),
        StructField("event_date", DateType()),
        StructField("landing_date", DateType()),
        StructField("landing_hour", IntegerType()),
    ]
)


def store_landing(
    spark: SparkSession,
    base: str,
    table: str,
    days: list[Day],
    layout: Layout = PLAIN,
    allow_missing: bool = False,
) -> None:
    """Copy whole landing days from JSON into the landing table, once.

    JSON has to be tokenised in full on every read, so jobs that touch the same day more
    than once should read the table. The days given are replaced. Rows are written
    where they were read, without a shuffle; a task that reads small files of several hours
    sorts them and writes a file for each hour.
    """
    rows = with_event_time(read_landing_hours(spark, base, days, layout, allow_missing))
    overwrite_days(rows, table, days, by="landing_date", then_by=("landing_hour",), rebalance=False)


def in_landing_span(day: Column, grace_hours: int = GRACE_HOURS) -> Column:
    """Whether a row landed on this day or within the grace hours around it. For a fixed
    day this is a condition on partition columns alone."""
    date, hour = F.col("landing_date"), F.col("landing_hour")
    return (
        (date == day)
        | ((date == F.date_sub(day, 1)) & (hour >= 24 - grace_hours))
        | ((date == F.date_add(day, 1)) & (hour < grace_hours))
    )


def read_landing_table(
    spark: SparkSession, table: str, day: Day, grace_hours: int = GRACE_HOURS
) -> DataFrame:
    """One day of the landing table with its grace hours; other partitions are pruned."""
    rows = spark.read.schema(LANDING_TABLE_SCHEMA).parquet(table)
    return rows.where(in_landing_span(F.lit(as_day(day)), grace_hours))


def read_landing_table_days(
    spark: SparkSession, table: str, first: Day, last: Day, grace_hours: int = GRACE_HOURS
) -> DataFrame:
    """What ``read_landing_days`` reads, from the landing table."""
    rows = spark.read.schema(LANDING_TABLE_SCHEMA).parquet(table)
    landed = F.col("landing_date").between(F.lit(shift(first, -1)), F.lit(shift(last, 1)))
    events = on_days(rows.where(landed), first, last)
    return events.where(in_landing_span(F.col("event_date"), grace_hours))
