"""Epoch-millisecond conversions.

Dates are computed from the epoch value itself, so the result never depends
on the session time zone; timestamps are UTC wall-clock ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MS_PER_DAY = 86_400_000


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_ms_to_timestamp(col) -> Column:
    """epoch milliseconds -> UTC timestamp (exact, no float step)."""
    return F.timestamp_add("MILLISECOND", _c(col), _epoch_ntz())


def epoch_ms_to_date(col) -> Column:
    """epoch milliseconds -> calendar date in UTC."""
    return F.date_from_unix_date(F.floor(_c(col) / F.lit(MS_PER_DAY)).cast("int"))


def event_month(date_col) -> Column:
    """month number 1-12 of a date; the year is deliberately ignored."""
    return F.month(_c(date_col))


def days_between(later, earlier) -> Column:
    """whole days from ``earlier`` to ``later``."""
    return F.datediff(_c(later), _c(earlier))
