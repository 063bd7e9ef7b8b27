"""Bag union by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.model import EVENT_SCHEMA


def conform(events: DataFrame) -> DataFrame:
    """Give the known columns their agreed type, so that reads inferred from
    different files cannot clash. Other columns are kept as they are."""
    known = {field.name: field.dataType for field in EVENT_SCHEMA}
    return events.select(
        *[
            F.col(name).cast(known[name]).alias(name) if name in known else F.col(name)
            for name in events.columns
        ]
    )


def union_reads(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all reads; a column missing from a read is NULL there."""
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [conform(read) for read in (first, *others)],
    )
