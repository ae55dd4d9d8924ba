"""Registered queries over the driver tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables.  Arrays and maps are returned as text (sorted where order is not
part of the value) so results can be hashed against the oracle; the
library functions themselves return real arrays and maps.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.functions.arrays import join_text
from cumulo.functions.maps import map_text
from cumulo.functions.text import minutes_from_text, token_flag
from cumulo.operators import (cumulative, datelist, devices, distinct_sets, facts, graph, heavy, history, joins,
                              metrics, quality, ranking, rolling)
from cumulo.plans import layout
from cumulo.sources import footers, standins
from cumulo.sources.session import checkpoint_root, work_path
from cumulo.sources.tables import read_table
from cumulo.streaming.daily import BucketedStore, PathStore, buckets_for, days_between, run_daily
from cumulo.streaming.intervals import IntervalStore
from cumulo.streaming.late import apply_late_dates, apply_late_values

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


# --------------------------------------------------------------------------
# J1 duplicate keys
# --------------------------------------------------------------------------
@register("duplicate_report", """
SELECT l_orderkey, l_linenumber, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def q_duplicate_report(spark, sf_dir):
    return quality.duplicate_report(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# --------------------------------------------------------------------------
# J2 fact load with dedup (flagship)
# --------------------------------------------------------------------------
_DETAIL_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "min_text"]


def lineitem_fact(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    d = standins.fact_details(lineitem).alias("l")
    o = orders.alias("o")
    cols = {
        "dim_order_date": F.to_date("o.o_orderdate"),
        "dim_order_year": F.year("o.o_orderdate"),
        "dim_orderkey": F.col("l.l_orderkey"),
        "dim_linenumber": F.col("l.l_linenumber"),
        "dim_partkey": F.col("l.l_partkey"),
        "dim_suppkey": F.col("l.l_suppkey"),
        "dim_is_own_supplier": F.col("l.l_suppkey") == F.col("o.o_custkey"),
        "dim_is_urgent": token_flag("o.o_orderpriority", "URGENT"),
        "dim_is_high": token_flag("o.o_orderpriority", "HIGH"),
        "dim_is_low": token_flag("o.o_orderpriority", "LOW"),
        "dim_returnflag": F.col("l.l_returnflag"),
        "dim_shipdate": F.to_date("l.l_shipdate"),
        "m_minutes": F.round(minutes_from_text("l.min_text"), 6),
        "m_quantity": F.col("l.l_quantity"),
        "m_extendedprice": F.col("l.l_extendedprice"),
        "m_discount": F.col("l.l_discount"),
    }
    order = [F.col(c).asc_nulls_first() for c in _DETAIL_ORDER]
    return facts.build_fact(d, o, "l_orderkey", "o_orderkey", ["l_orderkey", "l_linenumber"], cols, order)


_FACT_SQL = """
WITH d AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
                  l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
                  l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn,
         CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) || ':' || CAST(l_linenumber * 7 AS VARCHAR) AS min_text
  FROM lineitem)
SELECT CAST(o.o_orderdate AS DATE) AS dim_order_date,
       CAST(year(o.o_orderdate) AS INTEGER) AS dim_order_year,
       d.l_orderkey AS dim_orderkey, d.l_linenumber AS dim_linenumber,
       d.l_partkey AS dim_partkey, d.l_suppkey AS dim_suppkey,
       d.l_suppkey = o.o_custkey AS dim_is_own_supplier,
       coalesce(position('URGENT' IN o.o_orderpriority), 0) > 0 AS dim_is_urgent,
       coalesce(position('HIGH' IN o.o_orderpriority), 0) > 0 AS dim_is_high,
       coalesce(position('LOW' IN o.o_orderpriority), 0) > 0 AS dim_is_low,
       d.l_returnflag AS dim_returnflag,
       CAST(d.l_shipdate AS DATE) AS dim_shipdate,
       round(try_cast(split_part(d.min_text, ':', 1) AS DOUBLE)
             + CASE WHEN split_part(d.min_text, ':', 2) = '' THEN 0.0
                    ELSE try_cast(split_part(d.min_text, ':', 2) AS DOUBLE) END / 60.0, 6) AS m_minutes,
       d.l_quantity AS m_quantity, d.l_extendedprice AS m_extendedprice, d.l_discount AS m_discount
FROM d JOIN orders o ON d.l_orderkey = o.o_orderkey
WHERE d.rn = 1
"""


@register("build_fact", _FACT_SQL)
def q_build_fact(spark, sf_dir):
    return lineitem_fact(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders"))


# --------------------------------------------------------------------------
# Shared parameters for the activity jobs (testdata covers 2024-01-01..30)
# --------------------------------------------------------------------------


FIRST_DAY = _dt.date(2024, 1, 1)
AS_OF = _dt.date(2024, 1, 30)
INCREMENTAL_DAYS = 3
SEED_DAY = AS_OF - _dt.timedelta(days=INCREMENTAL_DAYS)


def _snapshot_out(df, key):
    return df.select(key, cumulative.dates_text("dates_active").alias("dates_active"),
                     "snapshot_date", F.size("dates_active").alias("n_days"))


def _dates_sql(key_expr, key_alias, where):
    return f"""
SELECT {key_alias}, string_agg(strftime(d, '%Y-%m-%d'), ',' ORDER BY d DESC) AS dates_active,
       DATE '{AS_OF}' AS snapshot_date, CAST(count(*) AS INTEGER) AS n_days
FROM (SELECT DISTINCT {key_expr} AS {key_alias}, CAST(ts AS DATE) AS d FROM events
      WHERE ts < TIMESTAMP '{AS_OF + _dt.timedelta(days=1)}' AND {where})
GROUP BY {key_alias}
"""


_USERS_SQL = _dates_sql("user_id", "user_id", "user_id IS NOT NULL")
_HOSTS_SQL = _dates_sql("event_type || '/' || json_extract_string(props, '$.k')", "host", "TRUE")


# J5 ----------------------------------------------------------------------
@register("rebuild_users", _USERS_SQL)
def q_rebuild_users(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return _snapshot_out(cumulative.rebuild_dates(ev, "user_id", "ts", AS_OF), "user_id")


def _bucketed_store(spark, name, key, partition_col, more_cols=()):
    """A store of the query's own; the first write fixes the bucket count from
    the snapshot's size, ``_load_days`` drops the catalog entry again."""
    table = f"{name}_{uuid.uuid4().hex[:10]}"
    return BucketedStore(spark, table, work_path(spark, name), key, None, partition_col, more_cols)


def _load_days(spark, store, seed, step):
    """Seed = closed form up to SEED_DAY, then one daily job per day."""
    store.write(seed, SEED_DAY)
    run_daily(spark, store, SEED_DAY + _dt.timedelta(days=1), AS_OF, step)
    return store.release(AS_OF)


def _once(df):
    """A day's aggregate that several branches read: computed once, kept in
    the shared checkpoint folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def _incremental_dates(spark, events, key, drop_null_keys, store):
    seed = cumulative.rebuild_dates(events, key, "ts", SEED_DAY, drop_null_keys=drop_null_keys)

    def step(prev, d):
        today = cumulative.active_keys(events, key, "ts", d, drop_null_keys=drop_null_keys)
        if not drop_null_keys:
            today = _once(today)  # read for the NULL key and for the others
        return cumulative.cumulate_dates(prev, today, key, d, null_safe_key=not drop_null_keys)

    return _load_days(spark, store, seed, step)


@register("cumulate_users", _USERS_SQL)
def q_cumulate_users(spark, sf_dir):
    """Daily loads into a day-partitioned table bucketed by user: yesterday's
    snapshot is read pre-partitioned, only today's keys are shuffled."""
    ev = _t(spark, sf_dir, "events").select("user_id", "ts")
    store = _bucketed_store(spark, "users_cumulated", "user_id", "snapshot_date")
    return _snapshot_out(_incremental_dates(spark, ev, "user_id", True, store), "user_id")


# J6 ----------------------------------------------------------------------
@register("cumulate_hosts", _HOSTS_SQL)
def q_cumulate_hosts(spark, sf_dir):
    """Hosts keep a NULL key (merged on its own); the rest meet on the
    bucketed snapshot like users."""
    ev = standins.sparse_hosts(_t(spark, sf_dir, "events")).withColumnRenamed("event_time", "ts")
    store = _bucketed_store(spark, "hosts_cumulated", "host", "snapshot_date")
    return _snapshot_out(_incremental_dates(spark, ev, "host", False, store), "host")


# J5 with late rows, and with a growing table -------------------------------
def _arrival(ev):
    """Which rows of the first daily load arrive after the last one: every
    seventh event of that day (the tables have no arrival time)."""
    first = SEED_DAY + _dt.timedelta(days=1)
    return (F.to_date("ts") == F.lit(first)) & (F.pmod("event_id", F.lit(7)) == 3)


@register("late_users", _USERS_SQL)
def q_late_users(spark, sf_dir):
    """Three days loaded without the late rows of the first; then these are
    applied to the three snapshots: equal to the rebuild."""
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    late = ev.where(_arrival(ev))
    on_time = ev.where(~F.coalesce(_arrival(ev), F.lit(False))).select("user_id", "ts")
    store = _bucketed_store(spark, "users_late", "user_id", "snapshot_date")
    store.write(cumulative.rebuild_dates(on_time, "user_id", "ts", SEED_DAY), SEED_DAY)
    run_daily(spark, store, SEED_DAY + _dt.timedelta(days=1), AS_OF, lambda prev, d: cumulative.cumulate_dates(
        prev, cumulative.active_keys(on_time, "user_id", "ts", d), "user_id", d))
    apply_late_dates(store, late, "user_id", "ts", AS_OF)
    return _snapshot_out(store.release(AS_OF), "user_id")


@register("cumulate_users_growing", _USERS_SQL)
def q_cumulate_users_growing(spark, sf_dir):
    """A table that outgrows its buckets: after the seed its buckets are split
    in two without a shuffle, and the days go on with twice as many."""
    ev = _t(spark, sf_dir, "events").select("user_id", "ts")
    store = _bucketed_store(spark, "users_growing", "user_id", "snapshot_date")
    store.write(cumulative.rebuild_dates(ev, "user_id", "ts", SEED_DAY), SEED_DAY)
    finer = store.refined(SEED_DAY, max(1, store.bytes_per_bucket(SEED_DAY) - 1))
    run_daily(spark, finer, SEED_DAY + _dt.timedelta(days=1), AS_OF, lambda prev, d: cumulative.cumulate_dates(
        prev, cumulative.active_keys(ev, "user_id", "ts", d), "user_id", d))
    if finer is not store:
        store.release(SEED_DAY)
    return _snapshot_out(finer.release(AS_OF), "user_id")


# J7 / J8 -----------------------------------------------------------------
def _datelist_sql(key_expr, key_alias, where, top_bit, days):
    mask = "& 4294967295" if top_bit > 31 else ""
    return f"""
WITH a AS (SELECT DISTINCT {key_expr} AS {key_alias},
                  date_diff('day', CAST(ts AS DATE), DATE '{AS_OF}') AS age
           FROM events WHERE ts < TIMESTAMP '{AS_OF + _dt.timedelta(days=1)}' AND {where}),
b AS (SELECT {key_alias},
             CAST(coalesce(sum(CASE WHEN age BETWEEN 0 AND {min(days - 1, top_bit)}
                                    THEN CAST(1 AS BIGINT) << ({top_bit} - age) END), 0) AS BIGINT) {mask} AS bits
      FROM a GROUP BY {key_alias})
SELECT {key_alias}, bits AS datelist_int, lpad(bin(bits), 32, '0') AS datelist_bits,
       bit_count(bits) > 0 AS dim_is_monthly_active,
       bit_count(bits & 4261412864) > 0 AS dim_is_weekly_active,
       bit_count(bits & 2147483648) > 0 AS dim_is_daily_active
FROM b
"""


@register("user_datelist", _datelist_sql("user_id", "user_id", "user_id IS NOT NULL", 31, 32))
def q_user_datelist(spark, sf_dir):
    snap = cumulative.rebuild_dates(_t(spark, sf_dir, "events"), "user_id", "ts", AS_OF)
    return datelist.datelist(snap, "user_id", AS_OF)


@register("user_datelist_compat", _datelist_sql("user_id", "user_id", "user_id IS NOT NULL", 32, 30))
def q_user_datelist_compat(spark, sf_dir):
    snap = cumulative.rebuild_dates(_t(spark, sf_dir, "events"), "user_id", "ts", AS_OF)
    return datelist.datelist(snap, "user_id", AS_OF, days=30, top_bit=32)


@register("host_datelist", _datelist_sql("event_type || '/' || json_extract_string(props, '$.k')",
                                         "host", "TRUE", 31, 32))
def q_host_datelist(spark, sf_dir):
    ev = standins.sparse_hosts(_t(spark, sf_dir, "events"))
    snap = cumulative.rebuild_dates(ev, "host", "event_time", AS_OF, drop_null_keys=False)
    return datelist.datelist(snap, "host", AS_OF)


# J5-J8 as a rolling state of 365 days ------------------------------------
_ROLLING_SQL = f"""
WITH d AS ({_datelist_sql("user_id", "user_id", "user_id IS NOT NULL", 31, 32)}),
n AS (SELECT user_id, count(DISTINCT CAST(ts AS DATE)) FILTER (WHERE age < 7) AS days_7,
             count(DISTINCT CAST(ts AS DATE)) FILTER (WHERE age < 28) AS days_28,
             count(DISTINCT CAST(ts AS DATE)) AS days_365
      FROM (SELECT user_id, ts, date_diff('day', CAST(ts AS DATE), DATE '{AS_OF}') AS age FROM events)
      WHERE age BETWEEN 0 AND 364 GROUP BY user_id)
SELECT d.*, days_7, days_28, days_365 FROM d JOIN n USING (user_id)
"""


@register("user_activity_365", _ROLLING_SQL)
def q_user_activity_365(spark, sf_dir):
    """Bitsets moved on by one day per load; the table is bucketed by user."""
    ev = _t(spark, sf_dir, "events").select("user_id", "ts")
    store = _bucketed_store(spark, "users_rolling", "user_id", "snapshot_date")
    seed = rolling.rebuild_bits(ev, "user_id", "ts", SEED_DAY)
    snapshot = _load_days(spark, store, seed, lambda prev, d: rolling.roll_bits(
        prev, cumulative.active_keys(ev, "user_id", "ts", d), "user_id", d))
    return rolling.activity_report(snapshot, "user_id")


@register("user_activity_365_rebuild", _ROLLING_SQL)
def q_user_activity_365_rebuild(spark, sf_dir):
    snapshot = rolling.rebuild_bits(_t(spark, sf_dir, "events"), "user_id", "ts", AS_OF)
    return rolling.activity_report(snapshot, "user_id")


# J9 / J10 / J11 ----------------------------------------------------------
_MONTH = FIRST_DAY
_EV_RANGE = f"ts >= TIMESTAMP '{_MONTH}' AND ts < TIMESTAMP '{AS_OF + _dt.timedelta(days=1)}'"
_DAYS_CTE = (f"days AS (SELECT CAST(d AS DATE) AS d FROM generate_series(DATE '{_MONTH}', "
             f"DATE '{AS_OF}', INTERVAL 1 DAY) t(d))")

_METRIC_SQL = f"""
WITH u AS (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL AND {_EV_RANGE}),
{_DAYS_CTE},
c AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events
      WHERE user_id IS NOT NULL AND {_EV_RANGE} GROUP BY ALL)
SELECT u.user_id, DATE '{_MONTH}' AS month_start, 'site_hits' AS metric_name,
       string_agg(CAST(coalesce(c.n, 0) AS VARCHAR), ',' ORDER BY days.d) AS metric_array
FROM u CROSS JOIN days LEFT JOIN c ON c.user_id = u.user_id AND c.d = days.d
GROUP BY u.user_id
"""


def _metric_out(df):
    return df.select("user_id", "month_start", "metric_name", join_text("metric_array").alias("metric_array"))


@register("metric_array", _METRIC_SQL)
def q_metric_array(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return _metric_out(metrics.rebuild_metric(ev, "user_id", "ts", AS_OF))


@register("metric_array_incremental", _METRIC_SQL)
def q_metric_array_incremental(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("user_id", "ts")
    store = _bucketed_store(spark, "array_metrics", "user_id", "date_partition")
    seed = metrics.rebuild_metric(ev, "user_id", "ts", SEED_DAY).withColumn("date_partition", F.lit(SEED_DAY))

    def step(prev, d):
        daily = metrics.daily_values(ev, "user_id", "ts", d, {"value": F.count(F.lit(1))})
        return (metrics.append_metric(prev, daily, "user_id", d, "value", "site_hits")
                       .withColumn("date_partition", F.lit(d)))

    return _metric_out(_load_days(spark, store, seed, step))


@register("late_metric", _METRIC_SQL)
def q_late_metric(spark, sf_dir):
    """Daily hits loaded without late rows, then the slots of their day set anew
    in the arrays of that day and the following."""
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    on_time = ev.where(~F.coalesce(_arrival(ev), F.lit(False)))
    store = _bucketed_store(spark, "late_metrics", "user_id", "date_partition")
    hits = {"value": F.count(F.lit(1))}
    store.write(metrics.rebuild_metric(on_time, "user_id", "ts", SEED_DAY).withColumn("date_partition", F.lit(SEED_DAY)), SEED_DAY)
    run_daily(spark, store, SEED_DAY + _dt.timedelta(days=1), AS_OF, lambda prev, d: metrics.append_metric(
        prev, metrics.daily_values(on_time, "user_id", "ts", d, hits), "user_id", d, "value", "site_hits").withColumn("date_partition", F.lit(d)))

    def recompute(keys, d):
        return metrics.daily_values(ev.join(keys, "user_id", "left_semi"), "user_id", "ts", d, hits)

    apply_late_values(store, ev.where(_arrival(ev)), recompute, "user_id", "ts", AS_OF, {"metric_array": "value"},
                      constants={"metric_name": "site_hits"})
    return _metric_out(store.release(AS_OF))


# fractional metrics: event values are doubles with cents, so sums are rounded
# for comparison only
_VALUE_SQL = f"""
WITH u AS (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL AND {_EV_RANGE}),
{_DAYS_CTE},
c AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n, sum(value) AS v FROM events
      WHERE user_id IS NOT NULL AND {_EV_RANGE} GROUP BY ALL)"""
_VALUE_ROWS_SQL = """
SELECT u.user_id, '{name}' AS metric_name, days.d AS metric_date, round(coalesce(c.{col}, 0), 4) AS value
FROM u CROSS JOIN days LEFT JOIN c ON c.user_id = u.user_id AND c.d = days.d"""


def _metric_rows(df):
    """One row per (user, metric, day): fractions compare as numbers."""
    return metrics.explode_metric(df, group=("user_id", "metric_name")).withColumn(
        "value", F.round(F.col("value").cast("double"), 4))


@register("metric_array_value", _VALUE_SQL + _VALUE_ROWS_SQL.format(name="revenue", col="v"))
def q_metric_array_value(spark, sf_dir):
    """A metric of doubles: the sum of ``events.value`` per user and day."""
    ev = _t(spark, sf_dir, "events")
    return _metric_rows(metrics.rebuild_metric(ev, "user_id", "ts", AS_OF, "revenue", F.col("value")))


@register("metric_two_incremental", _VALUE_SQL + _VALUE_ROWS_SQL.format(name="revenue", col="v")
          + "\nUNION ALL" + _VALUE_ROWS_SQL.format(name="site_hits", col="n"))
def q_metric_two_incremental(spark, sf_dir):
    """Two metrics in one table, partitioned by day and metric; every day each
    metric replaces its own part."""
    ev = _t(spark, sf_dir, "events").select("user_id", "ts", "value")
    values = {"revenue": (F.col("value"), F.sum("value")), "site_hits": (None, F.count(F.lit(1)))}
    store = _bucketed_store(spark, "array_metrics", "user_id", "date_partition", ("metric_name",))

    def typed(df, d):
        return df.withColumns({"metric_array": F.col("metric_array").cast("array<double>"), "date_partition": F.lit(d)})

    # a day's events are aggregated once for all metrics
    seed = _once(metrics.rebuild_metrics(ev, "user_id", "ts", SEED_DAY, {name: per_row for name, (per_row, _) in values.items()}))
    for name in values:
        one = seed.select("user_id", "month_start", F.lit(name).alias("metric_name"), F.col(name).alias("metric_array"))
        store.write(typed(one, SEED_DAY), SEED_DAY, metric_name=name)
    for d in days_between(SEED_DAY + _dt.timedelta(days=1), AS_OF):
        daily = _once(metrics.daily_values(ev, "user_id", "ts", d, {name: per_day for name, (_, per_day) in values.items()}))
        prev = store.read(d - _dt.timedelta(days=1))
        for name in values:
            one = metrics.append_metric(prev, daily.select("user_id", F.col(name).alias("value")), "user_id", d, "value", name)
            store.write(typed(one, d), d, metric_name=name)
    return _metric_rows(store.release(AS_OF))


@register("metric_by_day", f"""
WITH {_DAYS_CTE},
c AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events
      WHERE user_id IS NOT NULL AND {_EV_RANGE} GROUP BY ALL)
SELECT 'site_hits' AS metric_name, days.d AS metric_date, CAST(coalesce(c.n, 0) AS BIGINT) AS value
FROM days LEFT JOIN c ON c.d = days.d
WHERE EXISTS (SELECT 1 FROM c)
""")
def q_metric_by_day(spark, sf_dir):
    arrays = metrics.rebuild_metric(_t(spark, sf_dir, "events"), "user_id", "ts", AS_OF)
    return metrics.explode_metric(arrays)


@register("monthly_hits", f"""
SELECT DATE '{_MONTH}' AS month_start,
       CAST(count(*) FILTER (WHERE CAST(ts AS DATE) = DATE '{_MONTH}') AS BIGINT) AS num_hits_first_day,
       CAST(count(*) FILTER (WHERE CAST(ts AS DATE) = DATE '{_MONTH + _dt.timedelta(days=1)}') AS BIGINT)
           AS num_hits_second_day,
       CAST(count(*) FILTER (WHERE CAST(ts AS DATE) = DATE '{_MONTH + _dt.timedelta(days=2)}') AS BIGINT)
           AS num_hits_third_day
FROM events WHERE user_id IS NOT NULL AND {_EV_RANGE}
HAVING count(*) > 0
""")
def q_monthly_hits(spark, sf_dir):
    arrays = metrics.rebuild_metric(_t(spark, sf_dir, "events"), "user_id", "ts", AS_OF)
    hits = arrays.select("month_start", F.col("metric_array").alias("hit_array"),
                         F.lit(AS_OF.isoformat()).alias("date_partition"))
    return metrics.monthly_hits(hits, AS_OF.isoformat())


# J29 ---------------------------------------------------------------------
_HOST_REDUCED_SQL = f"""
WITH h AS (SELECT DISTINCT event_type AS host FROM events WHERE {_EV_RANGE}),
{_DAYS_CTE},
c AS (SELECT event_type AS host, CAST(ts AS DATE) AS d, count(*) AS hits,
             count(DISTINCT user_id) AS uv
      FROM events WHERE {_EV_RANGE} GROUP BY ALL)
SELECT h.host, DATE '{_MONTH}' AS month_start,
       string_agg(CAST(coalesce(c.hits, 0) AS VARCHAR), ',' ORDER BY days.d) AS hit_array,
       string_agg(CAST(coalesce(c.uv, 0) AS VARCHAR), ',' ORDER BY days.d) AS unique_visitors
FROM h CROSS JOIN days LEFT JOIN c ON c.host IS NOT DISTINCT FROM h.host AND c.d = days.d
GROUP BY h.host
"""


def _host_events(spark, sf_dir):
    return _t(spark, sf_dir, "events").select(F.col("event_type").alias("host"), "user_id", "ts")


def _reduced_out(df):
    return df.select("host", "month_start", join_text("hit_array").alias("hit_array"),
                     join_text("unique_visitors").alias("unique_visitors"))


@register("host_reduced", _HOST_REDUCED_SQL)
def q_host_reduced(spark, sf_dir):
    return _reduced_out(metrics.rebuild_host_activity(_host_events(spark, sf_dir), "host", "user_id", "ts", AS_OF))


@register("host_reduced_incremental", _HOST_REDUCED_SQL)
def q_host_reduced_incremental(spark, sf_dir):
    """Daily loads bucketed by host: the snapshot is not shuffled, the day's
    events are read once for the NULL host and the others."""
    ev = _host_events(spark, sf_dir)
    seed = (metrics.rebuild_host_activity(ev, "host", "user_id", "ts", SEED_DAY)
                   .withColumn("date_partition", F.lit(SEED_DAY)))
    store = _bucketed_store(spark, "host_activity_reduced", "host", "date_partition")

    def step(prev, d):
        daily = _once(metrics.daily_values(ev, "host", "ts", d, {
            "hits": F.count(F.lit(1)), "uv": F.count_distinct("user_id")}, drop_null_keys=False))
        return (metrics.append_metrics(prev, daily, "host", d, {"hit_array": "hits", "unique_visitors": "uv"},
                                       null_safe_key=True)
                       .withColumn("date_partition", F.lit(d)))

    return _reduced_out(_load_days(spark, store, seed, step))


# Distinct sets --------------------------------------------------
_VISITORS_SQL = f"""
SELECT event_type || '/' || json_extract_string(props, '$.k') AS host, DATE '{_MONTH}' AS month_start,
       count(DISTINCT user_id) AS n_visitors
FROM events WHERE {_EV_RANGE} AND user_id IS NOT NULL GROUP BY 1
"""


@register("host_monthly_visitors", _VISITORS_SQL)
def q_host_monthly_visitors(spark, sf_dir):
    """Unique visitors per host and month from the daily sets alone: every day
    is appended once, days are merged."""
    ev = standins.sparse_hosts(_t(spark, sf_dir, "events")).withColumnRenamed("event_time", "ts")
    store = PathStore(spark, work_path(spark, "host_visitors"), "date_partition")
    seed = distinct_sets.daily_sets(ev, "host", "user_id", "ts", _MONTH, SEED_DAY)
    store.write(seed)  # the days until then, each in its partition
    for d in days_between(SEED_DAY + _dt.timedelta(days=1), AS_OF):
        store.write(distinct_sets.daily_sets(ev, "host", "user_id", "ts", d, d), d)
    sets = spark.read.parquet(store.path).where((F.col("date_partition") >= F.lit(_MONTH)) & (F.col("date_partition") <= F.lit(AS_OF)))
    return distinct_sets.count_members(sets.withColumn("month_start", F.lit(_MONTH)), ["host", "month_start"], "n_visitors")


@register("host_monthly_visitors_rebuild", _VISITORS_SQL)
def q_host_monthly_visitors_rebuild(spark, sf_dir):
    ev = standins.sparse_hosts(_t(spark, sf_dir, "events"))
    sets = distinct_sets.daily_sets(ev, "host", "user_id", "event_time", _MONTH, AS_OF)
    return distinct_sets.count_members(sets.withColumn("month_start", F.lit(_MONTH)), ["host", "month_start"], "n_visitors")


# --------------------------------------------------------------------------
# Enrich the fact, conditional rate
# --------------------------------------------------------------------------

_FACT_CTE = "fact AS (" + _FACT_SQL.strip() + ")"


@register("enrich_fact", f"""
WITH {_FACT_CTE}
SELECT f.dim_orderkey, f.dim_linenumber, f.dim_suppkey, s.s_name, s.s_nationkey, f.m_extendedprice
FROM fact f JOIN supplier s ON f.dim_suppkey = s.s_suppkey
""")
def q_enrich_fact(spark, sf_dir):
    fact = lineitem_fact(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders"))
    out = facts.enrich(fact, _t(spark, sf_dir, "supplier"), "dim_suppkey", "s_suppkey")
    return out.select("dim_orderkey", "dim_linenumber", "dim_suppkey", "s_name", "s_nationkey",
                      "m_extendedprice")


@register("conditional_rate", f"""
WITH {_FACT_CTE}
SELECT dim_suppkey, count(*) AS num_rows, count(*) FILTER (WHERE dim_returnflag = 'R') AS num_flagged,
       round(CAST(count(*) FILTER (WHERE dim_returnflag = 'R') AS DOUBLE) / count(*), 6) AS flag_rate
FROM fact GROUP BY dim_suppkey
""")
def q_conditional_rate(spark, sf_dir):
    fact = lineitem_fact(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders"))
    out = facts.conditional_rate(fact, "dim_suppkey", F.col("dim_returnflag") == "R")
    return out.withColumn("flag_rate", F.round("flag_rate", 6))


# --------------------------------------------------------------------------
# J12 SCD2
# --------------------------------------------------------------------------
_PLAYERS_CTE = """p AS (
  SELECT o_custkey AS player_name, CAST(year(o_orderdate) AS INTEGER) AS current_season,
         CASE WHEN count(*) >= 3 THEN 'star' WHEN count(*) = 2 THEN 'good' ELSE 'average' END AS scoring_class
  FROM orders GROUP BY 1, 2)"""
_SCD_SQL = f"""
WITH {_PLAYERS_CTE},
g AS (SELECT *, row_number() OVER (PARTITION BY player_name ORDER BY current_season NULLS FIRST)
              - row_number() OVER (PARTITION BY player_name, scoring_class ORDER BY current_season NULLS FIRST)
              AS grp
      FROM p)
SELECT player_name, scoring_class, min(current_season) AS start_date, max(current_season) AS end_date
FROM g GROUP BY player_name, scoring_class, grp
"""


@register("scd2", _SCD_SQL)
def q_scd2(spark, sf_dir):
    players = standins.player_seasons(_t(spark, sf_dir, "orders"))
    return history.scd2(players, "player_name", "current_season", "scoring_class")


@register("scd2_windowed", _SCD_SQL)
def q_scd2_windowed(spark, sf_dir):
    """The one-shuffle window form, for inputs without a dominant entity (a
    customer's order years are few)."""
    players = standins.player_seasons(_t(spark, sf_dir, "orders"))
    return history.scd2_windowed(players, "player_name", "current_season", "scoring_class")


@register("scd2_compat", _SCD_SQL)
def q_scd2_compat(spark, sf_dir):
    players = standins.player_seasons(_t(spark, sf_dir, "orders"))
    return history.scd2(players, "player_name", "current_season", "scoring_class", null_safe=False)


# --------------------------------------------------------------------------
# J13 vertices
# --------------------------------------------------------------------------
@register("vertices", """
WITH t AS (SELECT l_suppkey AS team_id, l_returnflag AS abbreviation, l_linestatus AS nickname,
                  CAST(l_partkey AS VARCHAR) AS city, CAST(l_orderkey AS VARCHAR) AS arena,
                  CAST(year(l_shipdate) AS INTEGER) AS yearfounded FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY team_id
             ORDER BY yearfounded DESC NULLS LAST, nickname DESC NULLS LAST, abbreviation NULLS FIRST,
                      city NULLS FIRST, arena NULLS FIRST) AS rn FROM t)
SELECT team_id AS identifier, 'team' AS type,
       'abbreviation=' || coalesce(abbreviation, 'NULL') || ';arena=' || coalesce(arena, 'NULL') ||
       ';city=' || coalesce(city, 'NULL') || ';nickname=' || coalesce(nickname, 'NULL') ||
       ';year_founded=' || coalesce(CAST(yearfounded AS VARCHAR), 'NULL') AS properties
FROM r WHERE rn = 1
""")
def q_vertices(spark, sf_dir):
    teams = standins.teams(_t(spark, sf_dir, "lineitem"))
    order = [F.col("yearfounded").desc(), F.col("nickname").desc(), "abbreviation", "city", "arena"]
    v = graph.team_vertices(teams, order_by=order)
    return v.select("identifier", "type", map_text("properties").alias("properties"))


# --------------------------------------------------------------------------
# Cardinality and time range
# --------------------------------------------------------------------------
@register("cardinality", """
SELECT count(DISTINCT event_type) AS n_event_type, count(DISTINCT CAST(ts AS DATE)) AS n_event_date
FROM events
""")
def q_cardinality(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("event_date"))
    return quality.cardinality(ev, ["event_type", "event_date"])


@register("time_range", "SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM events")
def q_time_range(spark, sf_dir):
    return quality.time_range(_t(spark, sf_dir, "events"), "ts")


# --------------------------------------------------------------------------
# Per device, per user
# --------------------------------------------------------------------------
_BY_DEVICE_CTE = """d AS (
  SELECT user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS device_id, count(*) AS event_counts,
         array_to_string(list_sort(list_distinct(list(event_type))), ',') AS host_array
  FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2)"""


@register("events_by_device", f"WITH {_BY_DEVICE_CTE} SELECT * FROM d")
def q_events_by_device(spark, sf_dir):
    ev = standins.activity_events(_t(spark, sf_dir, "events"))
    out = devices.events_by_device(ev)
    return out.withColumn("host_array", join_text("host_array"))


@register("user_devices", f"""
WITH {_BY_DEVICE_CTE},
t AS (SELECT user_id, CAST(sum(event_counts) AS BIGINT) AS total_hits, max(event_counts) AS max_device_hits,
             count(device_id) AS num_devices FROM d GROUP BY user_id)
SELECT d.user_id, d.device_id, d.event_counts AS device_hits, total_hits, max_device_hits, num_devices
FROM d JOIN t ON d.user_id = t.user_id
""")
def q_user_devices(spark, sf_dir):
    """The J17 counts are written once (the reference's staging table) and
    read for the totals and the rows: events are scanned once."""
    ev = standins.activity_events(_t(spark, sf_dir, "events"))
    path = work_path(spark, "events_aggregated_staging")
    devices.device_counts(ev).write.mode("overwrite").parquet(path)
    return devices.user_devices(spark.read.parquet(path))


# --------------------------------------------------------------------------
# Matches, medals, maps
# --------------------------------------------------------------------------
_MATCH_CTES = """
matches AS (SELECT o_orderkey AS match_id, CAST(c_nationkey AS BIGINT) AS mapid, o_orderpriority AS playlist_id,
                   o_orderstatus = 'F' AS is_team_game, o_orderdate AS completion_date
            FROM orders JOIN customer ON o_custkey = c_custkey),
maps AS (SELECT CAST(n_nationkey AS BIGINT) AS mapid, n_name AS name, r_name AS description
         FROM nation JOIN region ON n_regionkey = r_regionkey),
details AS (SELECT l_orderkey AS match_id, l_suppkey AS player_gamertag,
                   CAST(trunc(l_quantity) AS INTEGER) AS player_total_kills, l_linenumber AS player_total_deaths
            FROM lineitem),
mmp AS (SELECT l_orderkey AS match_id, l_suppkey AS player_gamertag, l_partkey AS medal_id,
               l_linenumber AS "count" FROM lineitem),
medals AS (SELECT p_partkey AS medal_id, p_type AS name, p_brand AS classification FROM part),
staging AS (SELECT m.mapid, maps.name, maps.description, m.match_id, m.is_team_game, m.playlist_id,
                   m.completion_date, mmp.player_gamertag, mmp.medal_id, mmp."count"
            FROM matches m JOIN maps ON m.mapid = maps.mapid JOIN mmp ON m.match_id = mmp.match_id)"""


def _match_inputs(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return {
        "matches": standins.matches(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer")),
        "maps": standins.maps(_t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")),
        "details": standins.match_details(li),
        "mmp": standins.medals_matches_players(li),
        "medals": standins.medals(_t(spark, sf_dir, "part")),
    }


_STAGING_COLS = ["mapid", "name", "description", "match_id", "is_team_game", "playlist_id",
                 "completion_date", "player_gamertag", "medal_id", "count"]


def _staged(spark, sf_dir):
    """J19 staging rows, written once to the work folder and read back."""
    m = _match_inputs(spark, sf_dir)
    rows = joins.stage_map_medals(m["maps"], m["matches"], m["mmp"]).select(*_STAGING_COLS)
    path = work_path(spark, "stg_maps_medals")
    rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), m


@register("stage_map_medals", f"WITH {_MATCH_CTES} SELECT * FROM staging")
def q_stage_map_medals(spark, sf_dir):
    return _staged(spark, sf_dir)[0]


_MEDAL_JOIN_SQL = f"""
WITH {_MATCH_CTES}
SELECT s.match_id, s.mapid, s.player_gamertag, s.medal_id, md.name AS medal_name, s."count"
FROM staging s JOIN medals md ON s.medal_id = md.medal_id
"""


def _medal_join(spark, sf_dir, strategy):
    staged, m = _staged(spark, sf_dir)
    medals = m["medals"].withColumnRenamed("name", "medal_name")
    out = joins.join_small(staged, medals, "medal_id", strategy=strategy)
    return out.select("match_id", "mapid", "player_gamertag", "medal_id", "medal_name", "count")


@register("broadcast_join", _MEDAL_JOIN_SQL)
def q_broadcast_join(spark, sf_dir):
    return _medal_join(spark, sf_dir, "broadcast")


@register("shuffle_join", _MEDAL_JOIN_SQL)
def q_shuffle_join(spark, sf_dir):
    """The other leg of the comparison: sort-merge."""
    return _medal_join(spark, sf_dir, "shuffle")


@register("bucket_join", f"""
WITH {_MATCH_CTES},
d AS (SELECT match_id, count(*) AS num_player_rows, CAST(sum(player_total_kills) AS BIGINT) AS total_kills
      FROM details GROUP BY match_id),
md AS (SELECT match_id, count(*) AS num_medal_rows, CAST(sum("count") AS BIGINT) AS total_medals
       FROM mmp GROUP BY match_id)
SELECT m.match_id, m.playlist_id, m.mapid, d.num_player_rows, d.total_kills, md.num_medal_rows, md.total_medals
FROM matches m JOIN d ON m.match_id = d.match_id JOIN md ON m.match_id = md.match_id
""")
def q_bucket_join(spark, sf_dir):
    """Three tables bucketed by match, joined without a shuffle.

    Player and medal rows are summed per match before they are bucketed: a
    match that a third of all rows belong to is one row of its bucket, and
    the join is one to one.  The tables are the query's own: the result is
    written, then they are dropped.
    """
    m = _match_inputs(spark, sf_dir)
    d = (m["details"].groupBy("match_id")
         .agg(F.count(F.lit(1)).alias("num_player_rows"), F.sum("player_total_kills").alias("total_kills")))
    md = (m["mmp"].groupBy("match_id")
          .agg(F.count(F.lit(1)).alias("num_medal_rows"), F.sum("count").alias("total_medals")))
    n = buckets_for(_t(spark, sf_dir, "orders"))
    tables = [layout.write_bucketed(t, n, "match_id") for t in (m["matches"], d, md)]
    path = work_path(spark, "bucket_join")
    try:
        out = layout.bucket_join(spark, tables, "match_id")
        out.select("match_id", "playlist_id", "mapid", "num_player_rows", "total_kills", "num_medal_rows",
                   "total_medals").write.mode("overwrite").parquet(path)
    finally:
        layout.drop_bucketed(spark, tables)
    return spark.read.parquet(path)


def _played_matches(m):
    """Matches that have player rows, one row each (semi join: the details
    side contributes only its match ids, no rows are multiplied)."""
    return m["matches"].join(m["details"].select("match_id"), "match_id", "left_semi")


@register("top_player", f"""
WITH {_MATCH_CTES},
j AS (SELECT d.* FROM details d JOIN matches m ON d.match_id = m.match_id),
r AS (SELECT *, row_number() OVER (PARTITION BY match_id, player_gamertag
             ORDER BY player_total_deaths NULLS FIRST, player_total_kills DESC NULLS LAST) AS rn FROM j)
SELECT player_gamertag, round(avg(player_total_kills), 6) AS avg_kills
FROM r WHERE rn = 1 GROUP BY player_gamertag
ORDER BY avg(player_total_kills) DESC NULLS LAST, player_gamertag NULLS FIRST LIMIT 1
""")
def q_top_player(spark, sf_dir):
    m = _match_inputs(spark, sf_dir)
    out = ranking.top_by_mean(m["details"], "player_gamertag", "match_id", "player_total_kills", k=1,
                              order_by=[F.col("player_total_deaths").asc(), F.col("player_total_kills").desc()],
                              out_col="avg_kills", units=m["matches"])
    return out.withColumn("avg_kills", F.round("avg_kills", 6))


@register("top_playlist", f"""
WITH {_MATCH_CTES}
SELECT playlist_id, count(DISTINCT m.match_id) AS num_matches
FROM matches m JOIN details d ON m.match_id = d.match_id
GROUP BY playlist_id ORDER BY num_matches DESC, playlist_id NULLS FIRST LIMIT 1
""")
def q_top_playlist(spark, sf_dir):
    played = _played_matches(_match_inputs(spark, sf_dir))
    return ranking.top_by_units(played, "playlist_id", "match_id", k=1, out_col="num_matches")


@register("top_map", f"""
WITH {_MATCH_CTES}
SELECT mapid, count(DISTINCT m.match_id) AS num_matches
FROM matches m JOIN details d ON m.match_id = d.match_id
GROUP BY mapid ORDER BY num_matches DESC, mapid NULLS FIRST LIMIT 1
""")
def q_top_map(spark, sf_dir):
    played = _played_matches(_match_inputs(spark, sf_dir))
    return ranking.top_by_units(played, "mapid", "match_id", k=1, out_col="num_matches")


@register("top_map_medal", f"""
WITH {_MATCH_CTES}
SELECT s.mapid, CAST(sum(s."count") AS BIGINT) AS total_medals
FROM staging s JOIN medals md ON s.medal_id = md.medal_id
WHERE md.name = 'ECONOMY'
GROUP BY s.mapid ORDER BY total_medals DESC NULLS LAST, s.mapid NULLS FIRST LIMIT 1
""")
def q_top_map_medal(spark, sf_dir):
    """Nothing is staged: the medal is filtered in the scan, its few rows meet
    the medal rows, and only those look up their match's map."""
    m = _match_inputs(spark, sf_dir)
    medal = m["medals"].where(F.col("name") == "ECONOMY").select("medal_id")
    won = joins.join_small(m["mmp"].select("match_id", "medal_id", "count"), medal, "medal_id")
    known = joins.join_small(m["matches"].select("match_id", "mapid"), m["maps"].select("mapid"), "mapid")
    return ranking.top_by_sum(won.join(known, "match_id"), "mapid", "count", k=1, out_col="total_medals")


# --------------------------------------------------------------------------
# Per-user map of event type -> dates
# --------------------------------------------------------------------------
_TYPE_DATES_CTE = f"""pd AS (
  SELECT user_id, event_type,
         string_agg(strftime(d, '%Y-%m-%d'), '|' ORDER BY d DESC) AS dates
  FROM (SELECT DISTINCT user_id, coalesce(event_type, 'unknown') AS event_type, CAST(ts AS DATE) AS d FROM events
        WHERE user_id IS NOT NULL
          AND ts < TIMESTAMP '{AS_OF + _dt.timedelta(days=1)}')
  GROUP BY 1, 2)"""
_TYPE_DATES_SQL = f"""
WITH {_TYPE_DATES_CTE}
SELECT user_id, string_agg(event_type || '=' || dates, ';' ORDER BY event_type) AS device_activity_datelist,
       DATE '{AS_OF}' AS snapshot_date
FROM pd GROUP BY user_id
"""


def _type_dates_out(df):
    txt = map_text("device_activity_datelist",
                   value_text=lambda v: F.array_join(F.transform(v, lambda x: F.date_format(x, "yyyy-MM-dd")), "|"))
    return df.select("user_id", txt.alias("device_activity_datelist"), "snapshot_date")


@register("user_type_dates", _TYPE_DATES_SQL)
def q_user_type_dates(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return _type_dates_out(cumulative.rebuild_date_map(ev, "user_id", "event_type", "ts", AS_OF))


@register("user_type_dates_incremental", _TYPE_DATES_SQL)
def q_user_type_dates_incremental(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    store = _bucketed_store(spark, "user_devices_cumulated", "user_id", "snapshot_date")
    seed = cumulative.rebuild_date_map(ev, "user_id", "event_type", "ts", SEED_DAY)

    def step(prev, d):
        pairs = cumulative.active_pairs(ev, "user_id", "event_type", "ts", d)
        return cumulative.cumulate_date_map(prev, pairs, "user_id", "event_type", d)

    return _type_dates_out(_load_days(spark, store, seed, step))


@register("user_type_dates_long", f"""
SELECT user_id, event_type, string_agg(strftime(d, '%Y-%m-%d'), ',' ORDER BY d DESC) AS dates_active,
       DATE '{AS_OF}' AS snapshot_date
FROM (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS d FROM events
      WHERE user_id IS NOT NULL AND ts < TIMESTAMP '{AS_OF + _dt.timedelta(days=1)}')
GROUP BY user_id, event_type
""")
def q_user_type_dates_long(spark, sf_dir):
    """J27 as one row per (user, type): no list grows with a user's types."""
    ev = _t(spark, sf_dir, "events").where("user_id IS NOT NULL")
    snap = cumulative.rebuild_dates(ev, ["user_id", "event_type"], "ts", AS_OF, drop_null_keys=False)
    return snap.withColumn("dates_active", cumulative.dates_text("dates_active"))


@register("user_type_datelist", f"""
WITH a AS (SELECT DISTINCT user_id, coalesce(event_type, 'unknown') AS event_type,
                  date_diff('day', CAST(ts AS DATE), DATE '{AS_OF}') AS age
           FROM events WHERE user_id IS NOT NULL
             AND ts < TIMESTAMP '{AS_OF + _dt.timedelta(days=1)}'),
b AS (SELECT user_id, event_type,
             CAST(coalesce(sum(CASE WHEN age BETWEEN 0 AND 31 THEN CAST(1 AS BIGINT) << (31 - age) END), 0)
                  AS BIGINT) AS bits
      FROM a GROUP BY 1, 2)
SELECT user_id, string_agg(event_type || '=' || CAST(bits AS VARCHAR), ';' ORDER BY event_type) AS datelist_int
FROM b GROUP BY user_id
""")
def q_user_type_datelist(spark, sf_dir):
    snap = cumulative.rebuild_date_map(_t(spark, sf_dir, "events"), "user_id", "event_type", "ts", AS_OF)
    out = datelist.datelist_map(snap, "user_id", AS_OF)
    return out.select("user_id", map_text("datelist_int").alias("datelist_int"))


# --------------------------------------------------------------------------
# Layouts and sorts
# --------------------------------------------------------------------------
def _layout_events(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", F.col("event_type").alias("host"), "ts",
                     F.to_date("ts").alias("event_date"))


@register("write_layout", """
SELECT event_id, user_id, event_type AS host, CAST(ts AS DATE) AS event_date FROM events
""")
def q_write_layout(spark, sf_dir):
    path = work_path(spark, "events_sorted")
    layout.write_layout(_layout_events(spark, sf_dir), path, ["event_date", "host"],
                        cluster_cols=["event_date"])
    return spark.read.parquet(path).select("event_id", "user_id", "host", "event_date")


def _layout_sql(names):
    rows = " UNION ALL ".join(f"SELECT '{n}' AS layout" for n in names)
    return f"""
WITH l AS ({rows})
SELECT l.layout, (SELECT count(*) FROM events) AS num_rows, (SELECT count(*) FROM events) > 0 AS has_files,
       CAST(0 AS BIGINT) AS num_unsorted
FROM l
"""


@register("layout_report", _layout_sql(["sorted", "unsorted"]))
def q_layout_report(spark, sf_dir):
    """Layouts written, sized and checked; sizes differ by encoder version, so
    the registered columns are those that don't."""
    ev = _layout_events(spark, sf_dir)
    base = work_path(spark, "events_layouts")
    paths = {
        "sorted": layout.write_layout(ev, f"{base}/sorted", ["event_date", "host"], cluster_cols=["event_date"]),
        "unsorted": layout.write_layout(ev, f"{base}/unsorted", None, cluster_cols=["event_date"]),
    }
    sizes = layout.layout_report(spark, paths)
    checked = layout.layout_check(spark, {"sorted": (paths["sorted"], ["event_date", "host"]),
                                          "unsorted": (paths["unsorted"], None)})
    return sizes.join(checked, "layout").select(
        "layout", "num_rows", ((F.col("size") > 0) & (F.col("num_files") > 0) & (F.col("num_rows") > 0)).alias("has_files"), "num_unsorted")


@register("compare_layouts", _layout_sql(["date_host", "host_date", "user_ts", "z_user_date"]))
def q_compare_layouts(spark, sf_dir):
    """Three sorts and a space-filling order; which row groups two filters skip
    depends on sizes and is in the library's result."""
    ev = _layout_events(spark, sf_dir)
    found = layout.compare_layouts(ev, {
        "date_host": ["event_date", "host"],
        "host_date": ["host", "event_date"],
        "user_ts": ["user_id", "ts"],
    }, cluster_cols=["event_date"], curves={"z_user_date": ["user_id", "event_date"]})
    return found.select("layout", "num_rows", ((F.col("size") > 0) & (F.col("num_rows") > 0)).alias("has_files"), "num_unsorted")


@register("sort_global", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def q_sort_global(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return layout.sort_global(o, ["o_orderdate", "o_orderkey"])


@register("sort_local", "SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders")
def q_sort_local(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return layout.sort_local(o, ["o_orderpriority", "o_orderdate"], 
                             part_cols=["o_orderpriority", "o_orderdate", "o_orderkey"])


@register("scd2_incremental", _SCD_SQL)
def q_scd2_incremental(spark, sf_dir):
    """J12 loaded season by season: open runs are replaced, ended ones added."""
    players = standins.player_seasons(_t(spark, sf_dir, "orders"))
    rows = _once(players)
    store = IntervalStore(spark, work_path(spark, "player_runs"), "player_name", "current_season", "scoring_class")
    for season in sorted(r[0] for r in rows.select("current_season").distinct().collect()):  # seasons, not players
        store.load(rows.where(F.col("current_season") == season), season)
    return store.history()


# --------------------------------------------------------------------------
# Footers: columns of a layout, bounds without reading
# --------------------------------------------------------------------------
@register("layout_columns", """
WITH e AS (SELECT event_id, user_id, event_type AS host, CAST(ts AS DATE) AS event_date FROM events)
SELECT 'event_id' AS "column", count(*) AS num_rows, count(*) - count(event_id) AS nulls,
       CAST(min(event_id) AS VARCHAR) AS least, CAST(max(event_id) AS VARCHAR) AS greatest FROM e
UNION ALL SELECT 'user_id', count(*), count(*) - count(user_id), CAST(min(user_id) AS VARCHAR), CAST(max(user_id) AS VARCHAR) FROM e
UNION ALL SELECT 'host', count(*), count(*) - count(host), min(host), max(host) FROM e
UNION ALL SELECT 'event_date', count(*), count(*) - count(event_date), CAST(min(event_date) AS VARCHAR), CAST(max(event_date) AS VARCHAR) FROM e
""")
def q_layout_columns(spark, sf_dir):
    """A written layout as its footers describe it; bytes and encodings, which
    differ by writer, are in the library's result."""
    ev = _layout_events(spark, sf_dir).drop("ts")
    path = layout.write_layout(ev, work_path(spark, "events_columns"), ["event_date", "host"], cluster_cols=["event_date"])
    found = footers.column_report(footers.footers(spark, path), ev.schema)
    return found.select("column", "num_rows", "nulls", "least", "greatest")


@register("footer_bounds", """
SELECT count(*) AS num_rows, min(l_orderkey) AS min_l_orderkey, max(l_orderkey) AS max_l_orderkey,
       min(l_linenumber) AS min_l_linenumber, max(l_linenumber) AS max_l_linenumber,
       min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity
FROM lineitem
""")
def q_footer_bounds(spark, sf_dir):
    """J30 and counts answered by footers: aggregates pushed into the scan."""
    return quality.footer_bounds(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"])


# --------------------------------------------------------------------------
# J20 with a run-time filter, J22-J25 behind a summary
# --------------------------------------------------------------------------
@register("bloom_join", """
SELECT o.o_orderkey, l.l_linenumber, l.l_quantity, o.o_custkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderpriority = '1-URGENT' AND o.o_totalprice > 300000
""")
def q_bloom_join(spark, sf_dir):
    """Line items of few orders: those of others are dropped in the scan."""
    o = (_t(spark, sf_dir, "orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 300000))
         .select("o_orderkey", "o_custkey"))
    li = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    return joins.join_small(li, o, "o_orderkey", strategy="bloom")


@register("top_parts", """
SELECT l_partkey, count(*) AS num_lines FROM lineitem WHERE l_partkey IS NOT NULL
GROUP BY l_partkey ORDER BY num_lines DESC, l_partkey LIMIT 10
""")
def q_top_parts(spark, sf_dir):
    """The ten parts with most line items (the limit is the report)."""
    return heavy.top_counts(_t(spark, sf_dir, "lineitem"), "l_partkey", 10, out_col="num_lines")
