"""Late events in daily tables.

Rows of a past day arrive after that day was loaded.  Every snapshot from that
day on is wrong for the keys concerned, and for them alone.  The new (key, day)
pairs are worked out once; then the partitions from the first such day to the
last one loaded are corrected one by one, each in a job of its own: the
partition is read, the touched keys change, and it is replaced.  Earlier
partitions, and partitions of other metrics, are not written.

Applying the same late rows again changes nothing: dates are sets, and slots
are set to the day's recomputed value instead of being added to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.functions.arrays import pad_to, splice_slot
from cumulo.functions.dates import day
from cumulo.functions.util import as_date, names, to_pydate
from cumulo.operators.cumulative import _split_null_key
from cumulo.sources.session import checkpoint_root
from cumulo.streaming.daily import days_between


def late_pairs(late: DataFrame, key: str, ts: str, drop_null_keys: bool = True) -> DataFrame:
    """Distinct (key, ``late_day``) of late rows."""
    checkpoint_root(late.sparkSession)  # callers read the pairs once per day: they checkpoint them
    rows = late.where(F.col(key).isNotNull()) if drop_null_keys else late
    return rows.select(key, day(ts).alias("late_day")).distinct()


def _span(pairs: DataFrame):
    """First and last late day (two values), or None."""
    row = pairs.agg(F.min("late_day").alias("a"), F.max("late_day").alias("b")).first()
    return (row["a"], row["b"]) if row["a"] is not None else None


def apply_late_dates(store, late: DataFrame, key: str, ts: str, last_day, dates_col: str = "dates_active",
                     null_safe_key: bool = False) -> list:
    """Correct the snapshots of a cumulative dates table for late rows.

    ``store`` holds the days up to ``last_day``; ``late`` are rows of days
    before.  Returns the days whose partition was replaced.
    """
    pairs = late_pairs(late, key, ts, drop_null_keys=not null_safe_key).checkpoint()
    span = _span(pairs)
    if span is None or span[0] > to_pydate(last_day):
        return []
    done = []
    for d in days_between(span[0], last_day):
        add = (pairs.where(F.col("late_day") <= as_date(d)).groupBy(key)
                    .agg(F.collect_set("late_day").alias("_late")))
        snapshot = store.read(d).select(key, dates_col)

        def merge(tt, yy, null_safe, d=d):
            tt, yy = tt.alias("t"), yy.alias("y")
            on = F.col(f"t.{key}").eqNullSafe(F.col(f"y.{key}")) if null_safe else F.col(f"t.{key}") == F.col(f"y.{key}")
            dates = F.when(F.col("t._late").isNull(), F.col(f"y.{dates_col}")).otherwise(
                F.sort_array(F.array_union(F.coalesce(F.col(f"y.{dates_col}"), F.array().cast("array<date>")), F.col("t._late")), asc=False))
            return tt.join(yy, on, "full_outer").select(
                F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key), dates.alias(dates_col), as_date(d).alias(store.partition_col))

        store.replace(_split_null_key(add, snapshot, key, null_safe_key, merge), d)
        done.append(d)
    return done


def apply_late_values(store, late: DataFrame, recompute, key, ts: str, last_day, arrays: dict, constants: dict | None = None,
                      **part) -> list:
    """Correct month arrays for late rows.

    ``recompute(pairs, day)`` returns (key, <value cols>) of one day from all its
    rows, late ones included, for the keys of ``pairs`` that day; ``arrays`` maps
    array column -> value column; ``constants``: further columns of the table.
    Only days of the late rows' months are replaced, and only the ``part`` (for
    instance one metric) of them.
    """
    keys = names(key)
    pairs = late_pairs(late, keys[0], ts).checkpoint()
    span = _span(pairs)
    if span is None or span[0] > to_pydate(last_day):
        return []
    end = to_pydate(last_day)
    values = None
    days = sorted(r["late_day"] for r in pairs.select("late_day").distinct().collect())  # days, not keys
    for d in (x for x in days if x <= end):
        one = recompute(pairs.where(F.col("late_day") == as_date(d)).select(keys[0]), d).withColumn("late_day", as_date(d))
        values = one if values is None else values.unionByName(one)
    values = values.checkpoint()
    done = []
    for d in days_between(days[0], end):
        touched = [x for x in days if x <= d and (x.year, x.month) == (d.year, d.month)]
        if not touched:
            continue
        slots = [F.max(F.when(F.col("late_day") == as_date(x), F.col(v))).alias(f"_{v}_{x.day}")
                 for x in touched for v in arrays.values()]
        new = values.where(F.col("late_day").isin(touched)).groupBy(*keys).agg(*slots).alias("t")
        rows = store.read(d)
        for c, v in part.items():
            rows = rows.where(F.col(c) == v)
        old = rows.alias("y")
        j = new.join(old, [F.col(f"t.{k}") == F.col(f"y.{k}") for k in keys], "full_outer")
        cols = [F.coalesce(F.col(f"t.{k}"), F.col(f"y.{k}")).alias(k) for k in keys]
        cols.append(as_date(d.replace(day=1)).alias("month_start"))
        for array, value in arrays.items():
            col = pad_to(F.col(f"y.{array}"), d.day)
            for x in touched:
                late_value = F.col(f"t._{value}_{x.day}")
                col = F.when(late_value.isNull(), col).otherwise(splice_slot(col, x.day, late_value))
            cols.append(col.alias(array))
        cols += [F.lit(v).alias(c) for c, v in {**(constants or {}), **part}.items()]
        cols.append(as_date(d).alias(store.partition_col))
        store.replace(j.select(*cols), d, **part)
        done.append(d)
    return done
