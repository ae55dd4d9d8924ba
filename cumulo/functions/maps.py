"""Map helpers (property maps, per-key date histories)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cumulo.functions.util import as_col


def string_map(props: dict) -> Column:
    """``map(k1, cast(v1 as string), ...)`` from ``{key: column}``.

    Keys keep the given order; values are cast to string so mixed types fit
    one ``map<string,string>``.  NULL values are allowed.
    """
    parts = []
    for k, v in props.items():
        parts += [F.lit(k), as_col(v).cast("string")]
    return F.create_map(*parts)


def map_text(m, value_text=None, sep: str = ";") -> Column:
    """Map -> ``"k1=v1;k2=v2"`` with keys sorted, for hashing and display."""
    fmt = value_text or (lambda v: F.coalesce(v.cast("string"), F.lit("NULL")))
    return F.array_join(
        F.transform(F.array_sort(F.map_entries(as_col(m))),
                    lambda e: F.concat(e["key"], F.lit("="), fmt(e["value"]))),
        sep)
