"""Schemas of the stored metric tables."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from adpulse.model import KEYS
from adpulse.operators.rates import RATE

_KEY_FIELDS = [StructField(key, StringType()) for key in KEYS]
_DATE_FIELD = StructField("event_date", DateType())
_WINDOW_FIELD = StructField(
    "window",
    StructType([StructField("start", TimestampType()), StructField("end", TimestampType())]),
)

COUNT_TABLE = StructType(
    [
        *_KEY_FIELDS,
        StructField("EVENT_TYPE", StringType()),
        StructField("impressions", LongType()),
        _DATE_FIELD,
    ]
)
RATE_TABLE = StructType(
    [
        *_KEY_FIELDS,
        StructField("impressions", LongType()),
        StructField("clicks", LongType()),
        StructField(RATE, DoubleType()),
        _DATE_FIELD,
    ]
)

RATE_CHANGE_TABLE = StructType(
    [
        *_KEY_FIELDS,
        StructField("previous", DoubleType()),
        StructField("current", DoubleType()),
        StructField("pct_change", DoubleType()),
        _DATE_FIELD,
    ]
)
COUNT_CHANGE_TABLE = StructType(
    [
        *_KEY_FIELDS,
        StructField("EVENT_TYPE", StringType()),
        StructField("previous", LongType()),
        StructField("current", LongType()),
        StructField("pct_change", DoubleType()),
        _DATE_FIELD,
    ]
)

# What the update-mode streams log: the stored tables with the window of each row.
COUNT_LOG = StructType([_WINDOW_FIELD, *COUNT_TABLE])
RATE_LOG = StructType([_WINDOW_FIELD, *RATE_TABLE])
