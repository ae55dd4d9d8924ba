"""Top-k reports over joined match data.

Each report aggregates first (map-side partial aggregates) and then takes
``orderBy(...).limit(k)``, which Spark plans as a per-partition top-k
merged on the driver side of the plan (TakeOrderedAndProject): k rows per
task cross the wire, not the groups.  Ties are broken by the entity key.
The limit is the feature of these reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.functions.util import names
from cumulo.operators.quality import dedup


def top_by_mean(df: DataFrame, entity: str, unit, value: str, k: int = 1,
                order_by=None, out_col: str = "avg_value", units: DataFrame | None = None) -> DataFrame:
    """Entity with the highest mean ``value`` per unit, counting each
    (unit, entity) once (the first row under ``order_by``).

    ``units`` optionally restricts to units present there (e.g. matches
    that exist).  The restriction is a semi join applied *after* the dedup:
    the dedup shuffles on (unit, entity), which spreads a hot unit, and the
    semi join that follows feeds a partial aggregate, so AQE may split a
    hot unit's partition.
    """
    us = names(unit)
    src = df if order_by is not None else df.select(*us, entity, value)
    one = dedup(src, us + [entity], order_by)
    if units is not None:
        one = one.join(units.select(*us), us, "left_semi")
    return (one.groupBy(entity).agg(F.avg(value).alias(out_col))
               .orderBy(F.col(out_col).desc(), F.col(entity).asc()).limit(k))


def top_by_units(df: DataFrame, entity: str, unit, k: int = 1, out_col: str = "num_units") -> DataFrame:
    """Entity with the most distinct units (e.g. matches)."""
    us = names(unit)
    distinct_pairs = df.select(entity, *us).distinct()
    return (distinct_pairs.groupBy(entity).agg(F.count(F.lit(1)).alias(out_col))
                          .orderBy(F.col(out_col).desc(), F.col(entity).asc()).limit(k))


def top_by_sum(df: DataFrame, entity: str, value: str, where=None, k: int = 1,
               out_col: str = "total") -> DataFrame:
    """Entity with the largest sum of ``value`` over rows matching ``where``."""
    src = df if where is None else df.where(where)
    return (src.groupBy(entity).agg(F.sum(value).alias(out_col))
               .orderBy(F.col(out_col).desc(), F.col(entity).asc()).limit(k))
