"""Keyed upserts from an update-mode stream, kept as a log of changes.

Each micro-batch writes its changed groups into its own ``batch_id`` directory. A batch
that is run again after a failure replaces that directory, so nothing is duplicated. The
current value of a group is the one with the highest batch id.

Compaction folds the log into snapshots by day and then names a new version: the batch the
snapshots reach and the snapshot of each day. A reader goes by the newest version and by the log
beyond it. What a version no longer names is removed when ``KEPT_VERSIONS`` newer ones are there, so
a reader that has listed its files finishes with the values it began with. Batches lie in parts of
``PART_BATCHES``, which are removed whole.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from adpulse.sinks.files import make_dir, numbered_dirs, remove

LOG, SNAPSHOTS, VERSIONS, CURRENT = "log", "snapshots", "versions", "current"
PART_BATCHES = 100
#: Versions that stay readable beside the newest.
KEPT_VERSIONS = 1
#: Batches after which a stream folds its log.
COMPACT_EVERY = 100


def batch_writer(
    path: str, compact_every: int | None = None, key: tuple[str, ...] = ()
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that logs each batch below ``path``.

    The changed groups, one row each, are brought together by day first: a batch leaves about
    a file per day it touches and not one per day and state partition. With ``compact_every``,
    the log is folded after every so many batches, ``key`` telling the groups apart.
    """

    def write(changes: DataFrame, batch_id: int) -> None:
        (
            changes.hint("rebalance", "event_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("event_date")
            .parquet(f"{path}/{LOG}/part={batch_id // PART_BATCHES}/batch_id={batch_id}")
        )
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(changes.sparkSession, path, changes.schema, key)

    return write


def _stored(columns: StructType) -> StructType:
    own = [field for field in columns if field.name not in ("batch_id", "event_date")]
    return StructType(
        [*own, StructField("batch_id", LongType()), StructField("event_date", DateType())]
    )


def logged_batches(spark: SparkSession, path: str) -> list[int]:
    """The batches in the log, folded ones included that are still there."""
    parts = numbered_dirs(spark, f"{path}/{LOG}", "part")
    return [
        batch
        for part in parts
        for batch in numbered_dirs(spark, f"{path}/{LOG}/part={part}", "batch_id")
    ]


class Version(NamedTuple):
    """The last batch that is folded, and the snapshot that holds each day."""

    number: int
    through: int
    days: dict[date, int]


def _read_version(spark: SparkSession, path: str, number: int) -> Version:
    place = f"{path}/{VERSIONS}/version={number}"
    rows = spark.read.schema("event_date date, through long").json(place).collect()
    days = {row["event_date"]: row["through"] for row in rows if row["event_date"] is not None}
    return Version(number, max(row["through"] for row in rows), days)


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The versions that can be read, the newest last."""
    numbers = numbered_dirs(spark, f"{path}/{CURRENT}", "version")
    return [_read_version(spark, path, number) for number in numbers]


def _newest(spark: SparkSession, path: str) -> Version:
    numbers = numbered_dirs(spark, f"{path}/{CURRENT}", "version")
    return _read_version(spark, path, numbers[-1]) if numbers else Version(-1, -1, {})


def _name_version(spark: SparkSession, path: str, version: Version) -> None:
    """A version holds once its directory below ``current`` is there, which is made in one step."""
    rows = [(None, version.through), *version.days.items()]
    frame = spark.createDataFrame(rows, "event_date date, through long").coalesce(1)
    frame.write.mode("overwrite").json(f"{path}/{VERSIONS}/version={version.number}")
    make_dir(spark, f"{path}/{CURRENT}/version={version.number}")


def _named(version: Version) -> Column:
    """The partitions of snapshots that a version names."""
    by_snapshot: dict[int, list[date]] = {}
    for day, through in version.days.items():
        by_snapshot.setdefault(through, []).append(day)
    chosen = F.lit(False)
    for through, days in sorted(by_snapshot.items()):
        chosen = chosen | ((F.col("through") == through) & F.col("event_date").isin(days))
    return chosen


def read_changes(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """Every change since the newest version and the values of its snapshots. The files are listed
    here; the frame reads those, whatever is folded meanwhile."""
    stored = _stored(columns)
    version = _newest(spark, path)
    parts = []
    if numbered_dirs(spark, f"{path}/{LOG}", "part"):
        log = spark.read.schema(stored).parquet(f"{path}/{LOG}")
        parts.append(log.where(F.col("batch_id") > version.through).select(*stored.names))
    if version.days:
        with_through = StructType([*stored, StructField("through", LongType())])
        snapshots = spark.read.schema(with_through).parquet(f"{path}/{SNAPSHOTS}")
        parts.append(snapshots.where(_named(version)).select(*stored.names))
    if not parts:
        return spark.createDataFrame([], stored)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def latest(changes: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """The newest value of every column per key.

    One ``max_by`` per column instead of one over a struct: fixed-width buffers keep the
    aggregation hash-based, with partial results before the exchange.
    """
    values = [name for name in changes.columns if name not in (*key, "batch_id")]
    return changes.groupBy(*key).agg(
        *[F.max_by(name, "batch_id").alias(name) for name in values]
    )


def compact(
    spark: SparkSession,
    path: str,
    columns: StructType,
    key: tuple[str, ...],
    through: int | None = None,
    kept: int = KEPT_VERSIONS,
) -> None:
    """Fold the log up to a batch into a snapshot of the days it touches and name a new version.
    Days that were not touched stay in the snapshots they are in, so the cost follows the log and not
    the age of the table.

    The newest batch is left alone by default: the stream may still have to run it again.
    A snapshot gets a directory of its own and is complete before it is named, so a failure in
    between loses nothing. ``kept`` older versions stay readable; what none of those and the new one
    names is removed.
    """
    logged, current = logged_batches(spark, path), _newest(spark, path)
    if through is None:
        through = logged[-1] - 1 if logged else -1
    if not any(current.through < batch <= through for batch in logged):
        return
    log = spark.read.schema(_stored(columns)).parquet(f"{path}/{LOG}")
    folded = F.col("batch_id").between(current.through + 1, through)
    touched = log.where(folded).select("event_date").distinct()
    days = sorted(row.event_date for row in touched.collect())
    changes = read_changes(spark, path, columns).where(F.col("batch_id") <= through)
    changes = changes.where(F.col("event_date").isin(days))
    newest = latest(changes.withColumn("as_of", F.col("batch_id")), key)
    (
        newest.withColumnRenamed("as_of", "batch_id")
        .hint("rebalance", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("event_date")
        .parquet(f"{path}/{SNAPSHOTS}/through={through}")
    )
    named = Version(current.number + 1, through, {**current.days, **dict.fromkeys(days, through)})
    _name_version(spark, path, named)
    _clean(spark, path, kept)


def _clean(spark: SparkSession, path: str, kept: int) -> None:
    """Remove what only older versions than the ``kept`` before the newest name."""
    known = versions(spark, path)
    older, staying = known[: -1 - kept], known[-1 - kept :]
    if not older:
        return
    in_use = {(through, day) for version in staying for day, through in version.days.items()}
    gone = {(through, day) for version in older for day, through in version.days.items()} - in_use
    used_snapshots = {through for through, _ in in_use}
    for through in sorted({through for through, _ in gone}):
        place = f"{path}/{SNAPSHOTS}/through={through}"
        if through not in used_snapshots:
            remove(spark, place)
            continue
        for other, day in gone:
            if other == through:
                remove(spark, f"{place}/event_date={day.isoformat()}")
    # Batches that every version left has in its snapshots.
    for part in numbered_dirs(spark, f"{path}/{LOG}", "part"):
        if (part + 1) * PART_BATCHES - 1 <= staying[0].through:
            remove(spark, f"{path}/{LOG}/part={part}")
    for version in older:
        remove(spark, f"{path}/{CURRENT}/version={version.number}")
        remove(spark, f"{path}/{VERSIONS}/version={version.number}")
