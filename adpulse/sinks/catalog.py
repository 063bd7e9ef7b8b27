"""Metric tables by name, in databases of the session's catalog.

A replacement is written beside the table under a name of its own and takes its place when it is
complete. If writing it fails, the table and its rows are as they were.

Files hold their rows in order of day and type, which is what their statistics are read by. They are
not partitioned: a partition keeps the place it was written to, whatever its table is called later.

With ``buckets``, a table is laid out by the keys: a file per bucket and write, ordered by day. Days of
it are then compared, by grouping or by a join on the keys, without moving a row. All writes to a
table must name the same number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from adpulse.model import KEYS
from adpulse.sinks.daily import partitions_of

NEXT, PREVIOUS = "__next", "__previous"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database if it is not there, at a location the executors share."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def _name(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def _writer(rows: DataFrame, buckets: int | None) -> DataFrameWriter:
    by = partitions_of(rows)
    if buckets is None:
        return rows.hint("rebalance", *by).sortWithinPartitions(*by).write.format("parquet")
    # Dealt as the buckets are, so that each task writes one of them.
    dealt = rows.repartition(buckets, *KEYS)
    return dealt.write.format("parquet").bucketBy(buckets, *KEYS).sortBy(*by)


def _exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{database}.{table}")


def recover(spark: SparkSession, database: str, table: str) -> None:
    """Put back the table of a replacement that ended between its two renames; drop what a failed
    one has left."""
    if not _exists(spark, database, table) and _exists(spark, database, table + PREVIOUS):
        spark.sql(f"ALTER TABLE {_name(database, table + PREVIOUS)} RENAME TO {_name(database, table)}")
    for left in (NEXT, PREVIOUS):
        spark.sql(f"DROP TABLE IF EXISTS {_name(database, table + left)}")


def replace_table(rows: DataFrame, database: str, table: str, buckets: int | None = None) -> None:
    """Replace the whole table, every day of it."""
    spark = rows.sparkSession
    recover(spark, database, table)
    _writer(rows, buckets).saveAsTable(_name(database, table + NEXT))
    if _exists(spark, database, table):
        spark.sql(f"ALTER TABLE {_name(database, table)} RENAME TO {_name(database, table + PREVIOUS)}")
    spark.sql(f"ALTER TABLE {_name(database, table + NEXT)} RENAME TO {_name(database, table)}")
    spark.sql(f"DROP TABLE IF EXISTS {_name(database, table + PREVIOUS)}")


def append_table(rows: DataFrame, database: str, table: str, buckets: int | None = None) -> None:
    """Add rows to a table, by name of column; it is created if it is not there."""
    _writer(rows, buckets).mode("append").saveAsTable(_name(database, table))


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """The table, or the one before if a replacement ended between its two renames."""
    whole = _exists(spark, database, table) or not _exists(spark, database, table + PREVIOUS)
    return spark.table(_name(database, table if whole else table + PREVIOUS))
