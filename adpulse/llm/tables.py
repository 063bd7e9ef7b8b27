"""The given tables, reduced to the columns an operator names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Rows that a Python worker is given at once. Texts can be long, and a worker holds a few batches.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what Python workers hold, for this session: frames run after they are returned, so
    this can't be undone when a query function ends."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
