"""Reduced monthly facts: one array slot per day.

Row per (key, month, metric) instead of per (key, day): 31x fewer rows
to shuffle in later aggregations.

* ``rebuild_metric`` / ``rebuild_metrics`` – closed form for a month up to
  ``as_of``: one grouped aggregate whose state is a fixed array of 31
  sums (hash aggregate, map-side combine, one shuffle).
* ``append_metric`` – the daily step: full outer join of the month's rows
  with the day's values, written into the day's slot.  Rerunning a day
  rewrites its slot instead of appending another one (SURVEY §8-Q4).
* ``explode_metric`` – slot-wise totals as dated rows, arrays of any length.

Values keep their type: counts are bigint, sums of doubles are doubles.
A table may hold several metrics: its key is then (key, metric_name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.functions.arrays import slot_counts, splice_slot
from cumulo.functions.dates import day, day_slot
from cumulo.functions.util import as_col, as_date, names, to_pydate
from cumulo.operators.cumulative import _day_events, _split_null_key

MAX_SLOTS = 31


def month_bounds(as_of):
    d = to_pydate(as_of)
    first = d.replace(day=1)
    return first, (d - first).days + 1


def rebuild_metrics(events: DataFrame, key: str, ts: str, as_of, metrics: dict,
                    drop_null_keys: bool = True) -> DataFrame:
    """Month-to-date arrays for several metrics of the same rows.

    ``metrics`` maps an output array column to a per-row value Column
    (``None`` counts rows).  Output: key, month_start, one array per metric
    of length ``day(as_of)`` (zeros for idle days).
    """
    first, n = month_bounds(as_of)
    ev = _day_events(events, ts, first, as_of)
    if drop_null_keys:
        ev = ev.where(F.col(key).isNotNull())
    ev = ev.withColumn("_slot", day_slot(day(ts)))
    aggs = [F.slice(slot_counts("_slot", MAX_SLOTS, v), 1, n).alias(name) for name, v in metrics.items()]
    return (ev.groupBy(key).agg(*aggs)
              .withColumn("month_start", as_date(first))
              .select(key, "month_start", *metrics.keys()))


def rebuild_metric(events: DataFrame, key: str, ts: str, as_of, metric_name: str = "site_hits",
                   value=None, drop_null_keys: bool = True) -> DataFrame:
    """J9 closed form: (key, month_start, metric_name, metric_array)."""
    out = rebuild_metrics(events, key, ts, as_of, {"metric_array": value}, drop_null_keys)
    return out.select(key, "month_start", F.lit(metric_name).alias("metric_name"), "metric_array")


def daily_values(events: DataFrame, key: str, ts: str, on_day, metrics: dict,
                 drop_null_keys: bool = True) -> DataFrame:
    """One row per key active on ``on_day`` with one value per metric.

    ``metrics`` maps a name to an aggregate Column (e.g. ``F.count('*')``).
    """
    ev = _day_events(events, ts, on_day, on_day)
    if drop_null_keys:
        ev = ev.where(F.col(key).isNotNull())
    return ev.groupBy(key).agg(*[c.alias(n) for n, c in metrics.items()])


def append_metrics(prev: DataFrame, daily: DataFrame, key, on_day, arrays: dict,
                   null_safe_key: bool = False) -> DataFrame:
    """Write ``on_day``'s values into the month arrays.

    ``prev``: (key, month_start, <array cols>) for any months; only the
    month of ``on_day`` is read.  ``daily``: (key, <value cols>).
    ``key`` is a column or a list of columns, ``arrays`` maps array column ->
    value column.  Keys idle today get 0 in today's slot; new keys get zeros
    up to yesterday.  Set ``null_safe_key`` (one key column only) when NULL
    keys are kept, so the NULL key stays one row.
    """
    d = to_pydate(on_day)
    first = d.replace(day=1)
    slot = (d - first).days + 1
    keys = names(key)
    y = prev.where(F.col("month_start") == as_date(first)).select(*keys, *arrays.keys())
    t = daily.select(*keys, *arrays.values())

    def merge(tt, yy, null_safe):
        tt, yy = tt.alias("t"), yy.alias("y")
        on = [F.col(f"t.{k}").eqNullSafe(F.col(f"y.{k}")) if null_safe else F.col(f"t.{k}") == F.col(f"y.{k}")
              for k in keys]
        j = tt.join(yy, on, "full_outer")
        cols = [F.coalesce(F.col(f"t.{k}"), F.col(f"y.{k}")).alias(k) for k in keys]
        cols.append(as_date(first).alias("month_start"))
        for arr, val in arrays.items():
            v = F.coalesce(F.col(f"t.{val}"), F.lit(0))
            cols.append(splice_slot(F.col(f"y.{arr}"), slot, v).alias(arr))
        return j.select(*cols)

    if null_safe_key and len(keys) > 1:
        raise ValueError("null_safe_key takes one key column")
    return _split_null_key(t, y, keys[0], null_safe_key, merge)


def append_metric(prev: DataFrame, daily: DataFrame, key: str, on_day,
                  value_col: str = "value", metric_name: str | None = None) -> DataFrame:
    """J9 daily step on (key, month_start, metric_name, metric_array).

    With ``metric_name`` only that metric's rows are read and returned.
    Without, ``daily`` names the metric of each row and all metrics of
    ``prev`` are carried on: the key is (key, metric_name).
    """
    if metric_name is None:
        if "metric_name" not in daily.columns or "metric_name" not in prev.columns:
            raise ValueError("name the metric, or give daily and prev a metric_name column")
        out = append_metrics(prev, daily, [key, "metric_name"], on_day, {"metric_array": value_col})
        return out.select(key, "month_start", "metric_name", "metric_array")
    p = prev.where(F.col("metric_name") == metric_name) if "metric_name" in prev.columns else prev
    out = append_metrics(p, daily, key, on_day, {"metric_array": value_col})
    return out.select(key, "month_start", F.lit(metric_name).alias("metric_name"), "metric_array")


def explode_metric(df: DataFrame, array_col: str = "metric_array", group=("metric_name",),
                   date_col: str = "metric_date", value_col: str = "value") -> DataFrame:
    """Slot-wise totals per (group, month) as dated rows.

    All slots of arrays of any length are returned (the reference kept only
    the first three), up to the longest array of the group.  Slots are summed
    map-side, so a group reaches its reducer as one row per slot and task.
    """
    g = [*names(list(group)), "month_start"]
    slots = df.select(*g, F.posexplode(array_col).alias("_pos", "_value"))
    return (slots.groupBy(*g, "_pos").agg(F.coalesce(F.sum("_value"), F.lit(0)).alias(value_col))
                 .select(*[c for c in g if c != "month_start"],
                         F.date_add("month_start", F.col("_pos")).alias(date_col), value_col))


def monthly_hits(df: DataFrame, ds: str, array_col: str = "hit_array",
                 partition_col: str = "date_partition", n_days: int = 3) -> DataFrame:
    """For one partition, per month the totals of the first days.

    Output columns: month_start, num_hits_first_day, ..._second_day,
    ..._third_day (names for up to three days; further days are
    ``num_hits_day_<n>``).  Empty arrays count as zero.
    """
    labels = {0: "first", 1: "second", 2: "third"}
    aggs = []
    for i in range(n_days):
        name = f"num_hits_{labels[i]}_day" if i in labels else f"num_hits_day_{i + 1}"
        aggs.append(F.sum(F.coalesce(F.get(as_col(array_col), i), F.lit(0))).alias(name))
    return df.where(F.col(partition_col) == ds).groupBy("month_start").agg(*aggs)


def rebuild_host_activity(events: DataFrame, host: str, user: str, ts: str, as_of,
                          hits_col: str = "hit_array", visitors_col: str = "unique_visitors") -> DataFrame:
    """J29 closed form: per (host, month) the daily hit counts and daily
    distinct visitors, one slot per day.

    Daily distinct visitors need their own (host, day) aggregate first
    (distinct counts do not add up across days); the month arrays are then
    a second, small aggregate over at most 31 rows per host.
    """
    first, n = month_bounds(as_of)
    ev = _day_events(events, ts, first, as_of)
    daily = (ev.groupBy(host, day(ts).alias("_day"))
               .agg(F.count(F.lit(1)).alias("_hits"), F.count_distinct(user).alias("_uv")))
    daily = daily.withColumn("_slot", day_slot("_day"))
    return (daily.groupBy(host)
                 .agg(F.slice(slot_counts("_slot", MAX_SLOTS, "_hits"), 1, n).alias(hits_col),
                      F.slice(slot_counts("_slot", MAX_SLOTS, "_uv"), 1, n).alias(visitors_col))
                 .withColumn("month_start", as_date(first))
                 .select(host, "month_start", hits_col, visitors_col))
