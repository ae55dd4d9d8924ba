"""Cumulative snapshot tables.

A snapshot for day D holds one row per key with every active date so far
(newest first).  Two ways to get it:

* ``cumulate_dates`` – the daily production step: snapshot(D-1) full outer
  joined with the keys active on D.  One shuffle on the key per day; run
  it once per day and write the day's partition (see
  ``cumulo.streaming.daily``), never as a chain of joins in one lineage.
* ``rebuild_dates`` – the closed form for backfills and late data:
  ``distinct (key, day)`` then one array per key.  Equal to running the
  daily step over every day from the first one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulo.functions.dates import day
from cumulo.functions.util import as_date, names, to_pydate


def _key_cond(left: DataFrame, right: DataFrame, key: str, null_safe: bool) -> Column:
    return left[key].eqNullSafe(right[key]) if null_safe else left[key] == right[key]


def active_keys(events: DataFrame, key: str, ts: str, on_day, drop_null_keys: bool = True) -> DataFrame:
    """Distinct keys with at least one event on ``on_day``.

    The day filter is written as a range on ``ts`` so it reaches the
    parquet scan; the distinct is a grouped aggregate (map-side combine).
    """
    ev = _day_events(events, ts, on_day, on_day)
    if drop_null_keys:
        ev = ev.where(F.col(key).isNotNull())
    return ev.select(key).distinct()


def _is_ntz(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() == "timestamp_ntz"


def _ts_at(df: DataFrame, ts: str, d) -> Column:
    """Midnight of day ``d`` typed like ``df[ts]`` (so the comparison stays a
    plain range on the column and is pushed to the scan)."""
    txt = F.lit(to_pydate(d).isoformat())
    return txt.cast("timestamp_ntz") if _is_ntz(df, ts) else F.to_timestamp(txt)


def _day_events(events: DataFrame, ts: str, first=None, last=None) -> DataFrame:
    """Rows with ``first <= day(ts) <= last`` (either bound optional)."""
    out = events
    if first is not None:
        out = out.where(F.col(ts) >= _ts_at(events, ts, first))
    if last is not None:
        out = out.where(F.col(ts) < _ts_at(events, ts, last) + F.expr("INTERVAL 1 DAY"))
    return out


def cumulate_dates(prev: DataFrame, today: DataFrame, key: str, as_of,
                   dates_col: str = "dates_active", snapshot_col: str = "snapshot_date",
                   null_safe_key: bool = False) -> DataFrame:
    """Snapshot(as_of) from snapshot(as_of - 1) and today's active keys.

    ``prev`` has (key, dates_col, snapshot_col) and may hold other days:
    only ``as_of - 1`` is read.  ``today`` has one row per active key.
    Keys active today get ``as_of`` prepended; idle keys carry their
    history forward.  Every output row is dated ``as_of``.
    """
    d = as_date(as_of)
    y = prev.where(F.col(snapshot_col) == F.date_sub(d, 1)).select(key, dates_col)
    t = today.select(key).withColumn("_active", F.lit(True))

    def merge(tt, yy, null_safe):
        tt, yy = tt.alias("t"), yy.alias("y")
        j = tt.join(yy, _key_cond(tt, yy, key, null_safe), "full_outer")
        hist = F.col(f"y.{dates_col}")
        dates = (F.when(F.col("t._active").isNull(), hist)      # idle today: carry history
                  .when(hist.isNull(), F.array(d))               # first activity
                  .otherwise(F.concat(F.array(d), hist)))
        return j.select(F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
                        dates.alias(dates_col), d.alias(snapshot_col))

    return _split_null_key(t, y, key, null_safe_key, merge)


def _split_null_key(t: DataFrame, y: DataFrame, key: str, null_safe_key: bool, merge) -> DataFrame:
    """Full outer merge of today's rows with yesterday's on ``key``.

    With ``null_safe_key`` the NULL key (at most one row per side) is merged
    on its own with ``<=>`` and added back; the other keys meet on plain
    equality, which keeps a key-bucketed snapshot's partitioning (a
    null-safe join condition would make Spark re-shuffle both sides).
    """
    if not null_safe_key:
        return merge(t, y, False)
    nn = merge(t.where(F.col(key).isNotNull()), y.where(F.col(key).isNotNull()), False)
    only_null = merge(t.where(F.col(key).isNull()), y.where(F.col(key).isNull()), True)
    return nn.unionByName(only_null)


def seed_snapshot(spark, key_type: str, key: str = "user_id", dates_col: str = "dates_active",
                  snapshot_col: str = "snapshot_date") -> DataFrame:
    """An empty snapshot (the day before the first load)."""
    return spark.createDataFrame([], f"{key} {key_type}, {dates_col} array<date>, {snapshot_col} date")


def rebuild_dates(events: DataFrame, key, ts: str, as_of, since=None,
                  drop_null_keys: bool = True, dates_col: str = "dates_active",
                  snapshot_col: str = "snapshot_date") -> DataFrame:
    """Closed-form snapshot(as_of): every key active on or before ``as_of``
    (from ``since`` if given) with its active dates, newest first.  ``key`` is
    a column or a list of columns.

    The per-key array is bounded by the number of days in the range, and
    ``collect_set`` combines map-side, so a hot key reaches its reducer as
    at most one set of days per map task.
    """
    end = to_pydate(as_of)
    ev = _day_events(events, ts, since, end)
    keys = names(key)
    if drop_null_keys:
        ev = ev.dropna(subset=keys)
    return (ev.groupBy(*keys)
              .agg(F.sort_array(F.collect_set(day(ts)), asc=False).alias(dates_col))
              .withColumn(snapshot_col, as_date(end)))


def dates_text(dates) -> Column:
    """``yyyy-MM-dd`` dates joined by commas, in array order."""
    c = F.col(dates) if isinstance(dates, str) else dates
    return F.array_join(F.transform(c, lambda x: F.date_format(x, "yyyy-MM-dd")), ",")


# ---------------------------------------------------------------------------
# Key -> {sub_key: [dates]} maps (user_devices_cumulated)
# ---------------------------------------------------------------------------

#: The map key of rows whose sub key is NULL (a map key cannot be NULL).
UNKNOWN = "unknown"


def _map_key(sub_key: str, unknown: str) -> Column:
    """The sub key, ``unknown`` for NULL.  A real sub key of that name would
    become the same entry: it is refused, choose another name."""
    name = F.col(sub_key).cast("string")
    taken = F.raise_error(F.lit(f"sub key {unknown!r} occurs in {sub_key}: name NULLs differently")).cast("string")
    return F.when(name.isNull(), F.lit(unknown)).when(name == unknown, taken).otherwise(name).alias(sub_key)


def active_pairs(events: DataFrame, key: str, sub_key: str, ts: str, on_day, unknown: str = UNKNOWN) -> DataFrame:
    """Distinct (key, sub_key) pairs active on ``on_day``.  Rows with a NULL
    key are dropped; a NULL sub key is named ``unknown``, so its user stays."""
    ev = _day_events(events, ts, on_day, on_day)
    return ev.where(F.col(key).isNotNull()).select(key, _map_key(sub_key, unknown)).distinct()


def cumulate_date_map(prev: DataFrame, today_pairs: DataFrame, key: str, sub_key: str, as_of,
                      map_col: str = "device_activity_datelist",
                      snapshot_col: str = "snapshot_date") -> DataFrame:
    """Map snapshot(as_of) from map snapshot(as_of - 1) and today's
    (key, sub_key) pairs.  For each sub key active today, ``as_of`` is
    prepended to its date list; other entries carry forward.

    Today's pairs are grouped per key first (bounded by the number of
    distinct sub keys), then one full outer join on the key.
    """
    d = as_date(as_of)
    t = (today_pairs.groupBy(key)
                    .agg(F.map_from_entries(F.collect_list(F.struct(F.col(sub_key).cast("string"), F.array(d))))
                         .alias("_today")).alias("t"))
    y = prev.where(F.col(snapshot_col) == F.date_sub(d, 1)).select(key, map_col).alias("y")
    j = t.join(y, F.col(f"t.{key}") == F.col(f"y.{key}"), "full_outer")
    empty = F.create_map().cast("map<string,array<date>>")
    merged = F.map_zip_with(
        F.coalesce(F.col("t._today"), empty), F.coalesce(F.col(f"y.{map_col}"), empty),
        lambda k, today_dates, old: F.concat(F.coalesce(today_dates, F.array().cast("array<date>")),
                                             F.coalesce(old, F.array().cast("array<date>"))))
    return j.select(F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
                    merged.alias(map_col), d.alias(snapshot_col))


def rebuild_date_map(events: DataFrame, key: str, sub_key: str, ts: str, as_of,
                     map_col: str = "device_activity_datelist",
                     snapshot_col: str = "snapshot_date", unknown: str = UNKNOWN) -> DataFrame:
    """Closed-form map snapshot: per key, sub_key -> active dates (newest first);
    NULL sub keys are named ``unknown``.

    Two grouped aggregates: (key, sub_key) -> set of days (bounded by days),
    then key -> map.  The map holds the key's distinct sub keys, so it is for
    sub keys of a bounded domain (browsers, event types); for others keep one
    row per (key, sub_key): ``rebuild_dates(events, [key, sub_key], ...)``.
    """
    end = to_pydate(as_of)
    per_pair = (_day_events(events, ts, None, end)
                      .where(F.col(key).isNotNull())
                      .groupBy(key, _map_key(sub_key, unknown))
                      .agg(F.sort_array(F.collect_set(day(ts)), asc=False).alias("_dates")))
    return (per_pair.groupBy(key)
                    .agg(F.map_from_entries(F.collect_list(F.struct(F.col(sub_key).cast("string"), "_dates")))
                         .alias(map_col))
                    .withColumn(snapshot_col, as_date(end)))
