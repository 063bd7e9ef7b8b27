"""Ad events derived from the ``events`` and ``customer`` tables.

Fixed mapping: an event's brand is its customer's market segment; wall, wall group and
campaign come from the user id and the payload; every third payload value gives no
campaign, so NULL keys occur. An event lands up to 59 minutes after it happened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.days import Day, as_day, shift
from adpulse.model import (
    ALL_TYPES,
    EVENT_SCHEMA,
    POST_CLICK,
    POST_IMPRESSION,
    PRODUCT_CLICK,
    PRODUCT_IMPRESSION,
    WALL_IMPRESSION,
)

# Ad event type by type in the table.
TYPE_OF = {
    "view": PRODUCT_IMPRESSION,
    "click": PRODUCT_CLICK,
    "signup": POST_IMPRESSION,
    "purchase": POST_CLICK,
    "error": WALL_IMPRESSION,
}

# The columns used, declared: no job has to open the files to learn their schema.
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING"
CUSTOMERS = "c_custkey BIGINT, c_mktsegment STRING"

DERIVED = (
    "event_id",
    "user_id",
    "concat('w', user_id % 2) AS WALL_ID",
    "'g0' AS WALLGROUP_ID",
    "concat('c', nullif(try_cast(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS INT) % 3, 0))"
    " AS CAMPAIGN_ID",
    "CASE event_type "
    + " ".join(f"WHEN '{source}' THEN '{target}'" for source, target in TYPE_OF.items())
    + " END AS EVENT_TYPE",
    "lpad(CAST(day(ts) AS STRING), 2, '0') AS DAY",
    "concat(translate(CAST(ts AS STRING), ' ', 'T'), 'Z') AS ISOTIMESTAMP",
    "CAST(ts AS DATE) AS event_date",
    "ts + make_dt_interval(0, 0, CAST(event_id % 60 AS INT)) AS landed",
)


def _derived(
    spark: SparkSession,
    sf_dir: str,
    types: tuple[str, ...],
    first: Day | None = None,
    last: Day | None = None,
) -> DataFrame:
    """Everything about an event but its brand. Types and days are selected on the
    table's own columns, where the selection reaches the Parquet scan. The payload is one
    flat number and is read with a pattern: parsing it as JSON took four times as long as
    the rest of a rate."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    sources = [source for source, target in TYPE_OF.items() if target in types]
    if len(sources) < len(TYPE_OF):
        events = events.where(F.col("event_type").isin(sources))
    if first is not None:
        events = events.where(f"ts >= TIMESTAMP_NTZ '{as_day(first)}'")
    if last is not None:
        events = events.where(f"ts < TIMESTAMP_NTZ '{shift(last, 1)}'")
    return events.selectExpr(*DERIVED)


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = spark.read.schema(CUSTOMERS).parquet(f"{sf_dir}/customer.parquet")
    return customers.selectExpr("c_custkey AS user_id", "c_mktsegment AS BRAND")


def table_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``first_day, last_day`` of the table, null if it is empty."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.min("ts").cast("date").alias("first_day"), F.max("ts").cast("date").alias("last_day")
    )


def table_events(
    spark: SparkSession,
    sf_dir: str,
    types: tuple[str, ...] = ALL_TYPES,
    first: Day | None = None,
    last: Day | None = None,
) -> DataFrame:
    """Typed events, with the time text, the landing date and hour and the event id.

    Whether the customers are broadcast is left to the optimizer and its size threshold.
    Beyond it the join shuffles the short derived columns, not the payload, and adaptive
    execution splits the partition of a hot user.
    """
    return (
        _derived(spark, sf_dir, types, first, last)
        .join(_brands(spark, sf_dir), "user_id", "left")
        .selectExpr(
            "* EXCEPT (user_id, landed)",
            "CAST(landed AS DATE) AS landing_date",
            "lpad(CAST(hour(landed) AS STRING), 2, '0') AS landing_hour",
        )
    )


def table_counts(
    spark: SparkSession, sf_dir: str, types: tuple[str, ...] = ALL_TYPES
) -> DataFrame:
    """Events counted per user before the join with the customers.

    For customers too many to broadcast: a hot user reaches the shuffle as one row per
    group and map task. The rows are partial counts, to be summed by what reads them.
    """
    counted = (
        _derived(spark, sf_dir, types)
        .groupBy(
            "user_id", "WALL_ID", "WALLGROUP_ID", "CAMPAIGN_ID", "EVENT_TYPE", "event_date"
        )
        .agg(F.count("*").alias("impressions"))
    )
    return counted.join(_brands(spark, sf_dir), "user_id", "left").drop("user_id")


def text_events(spark: SparkSession, sf_dir: str, **selection) -> DataFrame:
    """The same events as they would land: text columns only."""
    return table_events(spark, sf_dir, **selection).select(*EVENT_SCHEMA.names)
