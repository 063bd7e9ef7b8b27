"""Whole hours, in UTC and without a zone, as landing directories are named."""

from __future__ import annotations

import datetime as dt

from adpulse.functions.days import Day

Hour = dt.datetime

HOUR = dt.timedelta(hours=1)
_EPOCH = dt.datetime(1970, 1, 1)


def as_hour(value: Hour | Day) -> Hour:
    """The hour a moment lies in; text like ``2021-06-30T05`` or a day, which is its first hour."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        value = value.astimezone(dt.UTC).replace(tzinfo=None)
    return value.replace(minute=0, second=0, microsecond=0)


def hours_between(first: Hour | Day, before: Hour | Day) -> list[Hour]:
    """The hours from ``first`` up to, and without, ``before``."""
    first, before = as_hour(first), as_hour(before)
    return [first + n * HOUR for n in range(max(0, (before - first) // HOUR))]


def hour_number(hour: Hour) -> int:
    return (as_hour(hour) - _EPOCH) // HOUR


def numbered_hour(number: int) -> Hour:
    return _EPOCH + number * HOUR


def this_hour() -> Hour:
    return as_hour(dt.datetime.now(dt.UTC))
