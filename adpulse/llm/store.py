"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from adpulse.scratch import scratch_dir
from adpulse.sinks.files import remove

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for as long as the block runs."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The same rows, read back from a table written to the shared folder.

    Cuts the lineage: an executor that is lost later costs a re-read and no recomputation. The
    shuffle files of the write are dropped as soon as it has ended.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    with setting(spark, CLEANUP, "true"):
        frame.write.parquet(path)
    result = spark.read.schema(frame.schema).parquet(path)
    result.stored_at = path
    return result


def drop(*frames: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for frame in frames:
        remove(frame.sparkSession, frame.stored_at)
