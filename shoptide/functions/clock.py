"""The explicit clock. No operator reads the wall clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(as_of: date | datetime) -> date:
    """Calendar day (UTC) of ``as_of``; a naive datetime is taken as UTC."""
    if isinstance(as_of, datetime):
        return (as_of.astimezone(timezone.utc) if as_of.tzinfo else as_of).date()
    return as_of


def epoch_ms(as_of: date | datetime) -> int:
    if not isinstance(as_of, datetime):
        as_of = datetime(as_of.year, as_of.month, as_of.day)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return (as_of - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(milliseconds=1)


def instant(as_of: date | datetime) -> Column:
    return F.timestamp_millis(F.lit(epoch_ms(as_of)))


def days_ago(as_of: date | datetime, moment: Column) -> Column:
    """Calendar days from ``moment`` to ``as_of``; negative after it."""
    return F.datediff(F.lit(day_of(as_of)), moment)


def within_days(as_of: date | datetime, moment: Column, oldest: int) -> Column:
    """True from ``oldest`` days ago through the day of ``as_of``.

    Written as a plain range on the column, so that it reaches the scan.
    """
    day = day_of(as_of)
    start = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
    return (moment >= F.lit(start - timedelta(days=oldest))) & (moment < F.lit(start + timedelta(days=1)))
