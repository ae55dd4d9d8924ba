"""Date helpers (day, month start, slot of a day in its month)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cumulo.functions.util import as_col


def day(ts) -> Column:
    """Calendar day of a timestamp / timestamp_ntz / date column."""
    return F.to_date(as_col(ts))


def month_start(d) -> Column:
    """First day of the month, as a date (``trunc``, not ``date_trunc``)."""
    return F.trunc(as_col(d), "month")


def day_slot(d) -> Column:
    """0-based index of a day within its month."""
    c = as_col(d)
    return F.datediff(c, F.trunc(c, "month"))

