"""Date and time column helpers (all built-in, codegen'd expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS_PER_DAY = 86_400_000_000.0


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(c: Column | str) -> Column:
    """timestamp -> calendar date."""
    return F.to_date(col(c))


def day_diff(end: Column | str, start: Column | str) -> Column:
    """Whole days between two dates/timestamps' dates (``end::date - start::date``); NULL if either is."""
    return F.datediff(as_date(end), as_date(start))


def fractional_days(start: Column | str, end: Column | str) -> Column:
    """Elapsed time from ``start`` to ``end`` in days, as a double; NULL if either is NULL."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(_MICROS_PER_DAY)


def pg_day_of_week(c: Column | str) -> Column:
    """Day of week with 0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(col(c)) - 1


def week_start(c: Column | str) -> Column:
    """Monday of the week containing the date."""
    return F.trunc(as_date(c), "week")


def month_start(c: Column | str) -> Column:
    return F.trunc(as_date(c), "month")
