"""Date helpers: an explicit ``as_of`` month replaces the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(d: dt.date) -> dt.date:
    return d.replace(day=1)


def add_months(d: dt.date, n: int) -> dt.date:
    """Driver-side month arithmetic on month starts (for parameters only)."""
    y, m = divmod(d.year * 12 + (d.month - 1) + n, 12)
    return dt.date(y, m + 1, 1)


def month_of(c: Column | str) -> Column:
    """month start of a date/timestamp column."""
    return F.trunc(F.col(c) if isinstance(c, str) else c, "MM")


def month_text_to_date(c: Column | str) -> Column:
    """'yyyy-MM' text to the month's first day."""
    return F.to_date(F.col(c) if isinstance(c, str) else c, "yyyy-MM")


def risk_window(as_of: dt.date, months: int = 24) -> tuple[dt.date, dt.date, dt.date]:
    """(history start, history end exclusive, forecast anchor) of a risk run:
    ``months`` months of history before ``as_of``; the forecast starts at the
    last full month."""
    end = month_start(as_of)
    return add_months(end, -months), end, add_months(end, -1)
