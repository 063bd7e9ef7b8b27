"""Aggregate and arithmetic expressions of the metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rows_where(condition: Column, count: str | None = None) -> Column:
    """Number of matching rows, and NULL rather than 0 when there are none.

    That is what an outer join of two counts gives for a missing side, so a rate with one
    side missing is NULL and never 0. With ``count``, rows are already counted and that
    column says how many events each stands for.
    """
    return F.sum(F.when(condition, F.lit(1) if count is None else F.col(count)))


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def percent_change(current: Column, previous: Column) -> Column:
    return F.try_divide(F.lit(100) * (current - previous), previous)
