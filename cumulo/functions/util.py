"""Small shared helpers for building Column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """A column name or Column -> Column."""
    return F.col(c) if isinstance(c, str) else c


def as_date(d) -> Column:
    """A ``date``/``'YYYY-MM-DD'`` literal or a Column -> date Column."""
    if isinstance(d, Column):
        return d
    if isinstance(d, _dt.datetime):
        d = d.date()
    if isinstance(d, _dt.date):
        d = d.isoformat()
    return F.to_date(F.lit(d))


def to_pydate(d) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))


def names(cols) -> list[str]:
    if isinstance(cols, str):
        return [cols]
    return list(cols)
