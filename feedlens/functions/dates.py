"""Day arithmetic and day filters.

All filters on raw events are written as half-open ranges on the event-time
column, so Catalyst pushes them into the Parquet scan (``PushedFilters``)
instead of evaluating ``to_date(time)`` on every row.  ``as_of`` replaces the
reference's ``today()`` so that runs are repeatable.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(d) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))


def day(col: str | Column = "time") -> Column:
    """Calendar day of an event time."""
    return F.to_date(F.col(col) if isinstance(col, str) else col)


def _ts(d: _dt.date) -> Column:
    return F.lit(d.isoformat() + " 00:00:00").cast("timestamp_ntz")


def time_in_days(first, last, col: str = "time") -> Column:
    """Events whose day lies in [first, last] (inclusive), as a range on the
    timestamp: ``first 00:00 <= time < last+1 00:00``."""
    a, b = as_date(first), as_date(last) + _dt.timedelta(days=1)
    c = F.col(col)
    return (c >= _ts(a)) & (c < _ts(b))


def yesterday(as_of, col: str = "time") -> Column:
    """``toDate(time) == today() - 1`` with today = ``as_of``."""
    d = as_date(as_of) - _dt.timedelta(days=1)
    return time_in_days(d, d, col)


def last_full_days(as_of, n: int = 7, col: str = "dt") -> Column:
    """The reports' window on a day column: ``dt > as_of - (n+1)`` and
    ``dt != as_of``.  Days after ``as_of`` pass, as in the original."""
    a = as_date(as_of)
    c = F.col(col)
    return (c > F.lit(a - _dt.timedelta(days=n + 1))) & (c != F.lit(a))


def time_last_full_days(as_of, n: int = 7, col: str = "time") -> Column:
    """Same window applied to raw event times, for pushdown below the
    aggregates: ``time >= as_of - n`` and not on day ``as_of``."""
    a = as_date(as_of)
    c = F.col(col)
    return (c >= _ts(a - _dt.timedelta(days=n))) & ~((c >= _ts(a)) & (c < _ts(a + _dt.timedelta(days=1))))
