"""Calendar days as driver-side parameters."""

from __future__ import annotations

import datetime as dt

Day = dt.date | str


def as_day(day: Day) -> dt.date:
    """Accept a date or its ISO text."""
    if isinstance(day, dt.datetime):
        return day.date()
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def shift(day: Day, days: int) -> dt.date:
    return as_day(day) + dt.timedelta(days=days)


def days_between(first: Day, last: Day) -> list[dt.date]:
    """Every day from first to last, both included."""
    start, end = as_day(first), as_day(last)
    return [start + dt.timedelta(days=n) for n in range((end - start).days + 1)]
