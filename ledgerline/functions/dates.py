"""Date helpers for runs and rendering."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def effective_date(requested: str, mocked: bool, today: _dt.date | None = None) -> str:
    """Run date: the requested date, or today's date when the run is mocked."""
    if mocked:
        return (today or _dt.date.today()).isoformat()
    return requested


def date_suffix(run_date: str) -> str:
    """``YYYY-MM-DD`` -> ``YYYY_MM_DD`` used for dated view and table names."""
    return run_date.replace("-", "_")


def month_of(run_date: str) -> str:
    """Two-digit month of a ``YYYY-MM-DD`` run date."""
    return "%02d" % _dt.date.fromisoformat(run_date).month


def calendar_valid(value: Column, fmt: str = "yyyyMMdd") -> Column:
    """True when ``value`` parses as a real calendar date in ``fmt`` (``20240230`` is not)."""
    return F.try_to_timestamp(value, F.lit(fmt)).isNotNull()


def month_start(run_date: str) -> str:
    """Default period start: first day of the run month (callers may pass their own function)."""
    d = _dt.date.fromisoformat(run_date)
    return d.replace(day=1).isoformat()
