"""Impressions per click.

``rate`` is the form to use. ``rate_by_join`` and ``rate_by_sql`` start from two stored
count tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.measures import ratio, rows_where
from adpulse.model import KEYS, Pair
from adpulse.operators.selection import of_type

RATE = "impressions_per_click"
DAILY = (*KEYS, "event_date")


def rate(events: DataFrame, pair: Pair, count: str | None = None) -> DataFrame:
    """Impressions, clicks and their ratio per keys and day: one scan, one exchange.

    NULL keys form a group of their own. A missing side stays NULL. With ``count``, the
    rows are counts and that column holds them: one pass over the events into counts of
    every type then serves all rates.
    """
    kind = F.col("EVENT_TYPE")
    return with_rate(
        of_type(events, *pair.types)
        .groupBy(*DAILY)
        .agg(
            rows_where(kind == pair.impression, count).alias("impressions"),
            rows_where(kind == pair.click, count).alias("clicks"),
        )
    )


def with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn(RATE, ratio(F.col("impressions"), F.col("clicks")))


def join_counts(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Full join of two count tables on keys and day.

    A NULL key matches nothing here and leaves two half rows; ``rate_by_join`` and
    ``rate_by_sql`` bring them together again.
    """
    return (
        impressions.withColumnRenamed("EVENT_TYPE", "impression_type")
        .join(clicks.withColumnRenamed("EVENT_TYPE", "click_type"), list(DAILY), "full")
    )


def rate_by_join(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Rate from two stored count tables, through the join."""
    return regroup(join_counts(impressions, clicks))


def regroup(joined: DataFrame) -> DataFrame:
    """One row per keys and day again, NULL keys included, with its rate."""
    return with_rate(
        joined.groupBy(*DAILY).agg(
            F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks")
        )
    )


def rate_by_sql(spark: SparkSession, joined: DataFrame) -> DataFrame:
    """The same regrouping as SQL text over a frame, without a shared view name."""
    return spark.sql(
        f"""
        SELECT {", ".join(DAILY)},
               sum(impressions) / sum(clicks) AS {RATE}
        FROM {{joined}}
        GROUP BY {", ".join(DAILY)}
        """,
        joined=joined,
    )
