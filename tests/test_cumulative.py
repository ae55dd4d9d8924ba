"""Cumulative snapshots (J5, J6, J27) and the daily loader."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulo.operators import cumulative
from cumulo.sources.session import work_path
from cumulo.sources.tables import read_table
from cumulo.streaming.daily import run_daily, write_day
from tests.conftest import SF_SMALL, rows

D = dt.date


@pytest.fixture()
def events(spark):
    data = [
        (1, "2023-01-01 10:00:00", "a"),   # seed day
        (1, "2023-01-01 11:00:00", "a"),   # same user twice a day
        (2, "2023-01-02 09:00:00", "b"),   # new key on day 2
        (1, "2023-01-03 08:00:00", "b"),   # returning key
        (None, "2023-01-03 08:00:00", "c"),  # NULL user
        (3, "2023-01-03 23:59:59", "a"),
    ]
    return (spark.createDataFrame(data, "user_id bigint, ts string, host string")
                 .withColumn("ts", F.to_timestamp("ts")))


def test_cumulate_step_cases(spark, events):
    seed = cumulative.seed_snapshot(spark, "bigint")
    d1 = cumulative.cumulate_dates(seed.withColumn("snapshot_date", F.lit(D(2022, 12, 31))),
                                   cumulative.active_keys(events, "user_id", "ts", D(2023, 1, 1)),
                                   "user_id", D(2023, 1, 1))
    assert rows(d1) == [(1, [D(2023, 1, 1)], D(2023, 1, 1))]
    d2 = cumulative.cumulate_dates(d1, cumulative.active_keys(events, "user_id", "ts", D(2023, 1, 2)),
                                   "user_id", D(2023, 1, 2))
    assert rows(d2) == [(1, [D(2023, 1, 1)], D(2023, 1, 2)), (2, [D(2023, 1, 2)], D(2023, 1, 2))]
    d3 = cumulative.cumulate_dates(d2, cumulative.active_keys(events, "user_id", "ts", D(2023, 1, 3)),
                                   "user_id", D(2023, 1, 3))
    assert rows(d3) == [(1, [D(2023, 1, 3), D(2023, 1, 1)], D(2023, 1, 3)),
                        (2, [D(2023, 1, 2)], D(2023, 1, 3)),      # idle key carried forward
                        (3, [D(2023, 1, 3)], D(2023, 1, 3))]      # NULL user dropped
    # the closed form gives the same snapshot
    assert rows(cumulative.rebuild_dates(events, "user_id", "ts", D(2023, 1, 3))) == rows(d3)


def test_host_cumulation_keeps_null_key_once(spark, events):
    ev = events.withColumn("host", F.when(F.col("host") == "c", None).otherwise(F.col("host")))
    path = work_path(spark, "hosts_test")

    def step(prev, d):
        today = cumulative.active_keys(ev, "host", "ts", d, drop_null_keys=False)
        return cumulative.cumulate_dates(prev, today, "host", d, null_safe_key=True)

    seed = spark.createDataFrame([], "host string, dates_active array<date>, snapshot_date date")
    out = run_daily(spark, path, D(2023, 1, 1), D(2023, 1, 3), step, seed=seed)
    got = {r["host"]: r["dates_active"] for r in out.collect()}
    assert got[None] == [D(2023, 1, 3)]
    assert got["a"] == [D(2023, 1, 3), D(2023, 1, 1)]
    assert rows(out) == rows(cumulative.rebuild_dates(ev, "host", "ts", D(2023, 1, 3), drop_null_keys=False))


def test_daily_rerun_and_missing_day(spark, events):
    path = work_path(spark, "users_rerun")

    def step(prev, d):
        return cumulative.cumulate_dates(prev, cumulative.active_keys(events, "user_id", "ts", d), "user_id", d)

    seed = cumulative.seed_snapshot(spark, "bigint")
    first = rows(run_daily(spark, path, D(2023, 1, 1), D(2023, 1, 3), step, seed=seed))
    again = rows(run_daily(spark, path, D(2023, 1, 3), D(2023, 1, 3), step))  # rerun day 3
    assert first == again
    with pytest.raises(ValueError, match="missing"):
        run_daily(spark, path, D(2023, 1, 6), D(2023, 1, 6), step)      # day 5 never loaded


def test_incremental_equals_rebuild_on_testdata(spark):
    ev = read_table(spark, SF_SMALL, "events").select("user_id", "ts")
    path = work_path(spark, "users_prop")
    write_day(cumulative.rebuild_dates(ev, "user_id", "ts", D(2024, 1, 20)), path, "snapshot_date")

    def step(prev, d):
        return cumulative.cumulate_dates(prev, cumulative.active_keys(ev, "user_id", "ts", d), "user_id", d)

    inc = run_daily(spark, path, D(2024, 1, 21), D(2024, 1, 30), step)
    assert rows(inc) == rows(cumulative.rebuild_dates(ev, "user_id", "ts", D(2024, 1, 30)))


def test_date_map_cumulation(spark):
    data = [
        (1, "2023-01-01 10:00:00", "chrome"),   # seen only before
        (1, "2023-01-02 10:00:00", "firefox"),  # seen only today
        (2, "2023-01-01 10:00:00", "chrome"),   # seen before and today
        (2, "2023-01-02 10:00:00", "chrome"),
        (3, "2023-01-02 10:00:00", None),       # NULL browser
    ]
    ev = spark.createDataFrame(data, "user_id bigint, ts string, browser string").withColumn("ts", F.to_timestamp("ts"))
    day1 = cumulative.rebuild_date_map(ev, "user_id", "browser", "ts", D(2023, 1, 1))
    day2 = cumulative.cumulate_date_map(day1, cumulative.active_pairs(ev, "user_id", "browser", "ts", D(2023, 1, 2)),
                                        "user_id", "browser", D(2023, 1, 2))
    got = {r["user_id"]: r["device_activity_datelist"] for r in day2.collect()}
    assert got == {1: {"chrome": [D(2023, 1, 1)], "firefox": [D(2023, 1, 2)]},
                   2: {"chrome": [D(2023, 1, 2), D(2023, 1, 1)]},
                   3: {"unknown": [D(2023, 1, 2)]}}  # a NULL sub key keeps its user
    closed = cumulative.rebuild_date_map(ev, "user_id", "browser", "ts", D(2023, 1, 2))
    assert {r["user_id"]: r["device_activity_datelist"] for r in closed.collect()} == got


def test_bucketed_store_reads_yesterday_without_shuffle(spark):
    import re
    from cumulo.plans.inspect import physical_plan, session_conf
    from cumulo.streaming.daily import BucketedStore

    ev = read_table(spark, SF_SMALL, "events").select("user_id", "ts")
    store = BucketedStore(spark, "snap_bucket_test", work_path(spark, "snap_bucket_test"), "user_id", 8)
    store.write(cumulative.rebuild_dates(ev, "user_id", "ts", D(2024, 1, 20)))

    def step(prev, d):
        return cumulative.cumulate_dates(prev, cumulative.active_keys(ev, "user_id", "ts", d), "user_id", d)

    def snapshot_side_shuffled(plan):
        """Is there an Exchange between the snapshot scan and the join?"""
        lines = plan.splitlines()
        i = next(k for k, ln in enumerate(lines) if "FileScan" in ln and "snap_bucket_test" in ln)
        for ln in reversed(lines[:i]):
            op = re.sub(r"^[\s:+\-*()0-9]*", "", ln).split(" ")[0]
            if op in ("Project", "Filter", "ColumnarToRow", "Sort"):
                continue
            return op == "Exchange"
        return False

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}
    with session_conf(spark, **conf):
        # more shuffle partitions than buckets: Spark would shuffle the snapshot too
        plain = physical_plan(step(store.read(D(2024, 1, 20)), D(2024, 1, 21)))
        with store.planning():  # how the store plans its writes
            plan = physical_plan(step(store.read(D(2024, 1, 20)), D(2024, 1, 21)))
    assert snapshot_side_shuffled(plain)
    # the snapshot side is a bucketed scan feeding the join directly
    assert "Bucketed: true" in plan and not snapshot_side_shuffled(plan)

    def step_null_safe(prev, d):
        today = cumulative.active_keys(ev, "user_id", "ts", d, drop_null_keys=False)
        return cumulative.cumulate_dates(prev, today, "user_id", d, null_safe_key=True)

    with session_conf(spark, **conf), store.planning():
        plan_ns = physical_plan(step_null_safe(store.read(D(2024, 1, 20)), D(2024, 1, 21)))
    # keeping the NULL key does not cost the bucketed partitioning
    assert "Bucketed: true" in plan_ns and not snapshot_side_shuffled(plan_ns)
    inc = rows(run_daily(spark, store, D(2024, 1, 21), D(2024, 1, 30), step))
    assert inc == rows(cumulative.rebuild_dates(ev, "user_id", "ts", D(2024, 1, 30)))
    store.write(step(store.read(D(2024, 1, 29)), D(2024, 1, 30)))  # rerun of the last day
    spark.catalog.refreshTable(store.table)
    assert rows(store.read(D(2024, 1, 30))) == inc


def test_stores_replace_only_their_day_under_static_overwrite_conf(spark):
    from cumulo.plans.inspect import session_conf
    from cumulo.streaming.daily import BucketedStore, PathStore

    d1 = spark.createDataFrame([(1, [D(2023, 1, 1)], D(2023, 1, 1))],
                               "user_id bigint, dates_active array<date>, snapshot_date date")
    d2 = d1.withColumn("snapshot_date", F.lit(D(2023, 1, 2)))
    with session_conf(spark, **{"spark.sql.sources.partitionOverwriteMode": "static"}):
        for store in (BucketedStore(spark, "static_conf_test", work_path(spark, "static_conf_test"), "user_id", 4),
                      PathStore(spark, work_path(spark, "static_conf_path"))):
            store.write(d1)
            store.write(d2)
            store.write(d2)  # rerun
            assert store.exists(D(2023, 1, 1)) and store.exists(D(2023, 1, 2))
            assert store.read(D(2023, 1, 1)).count() == 1 and store.read(D(2023, 1, 2)).count() == 1
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_bucketed_store_reattaches_existing_data(spark):
    from cumulo.streaming.daily import BucketedStore
    path = work_path(spark, "reattach")
    d1 = spark.createDataFrame([(1, [D(2023, 1, 1)], D(2023, 1, 1))],
                               "user_id bigint, dates_active array<date>, snapshot_date date")
    BucketedStore(spark, "reattach_a", path, "user_id", 4).write(d1)
    # a later job whose catalog does not know the table: same folder, new name
    again = BucketedStore(spark, "reattach_b", path, "user_id", 4)
    assert again.exists(D(2023, 1, 1))
    again.write(d1.withColumn("snapshot_date", F.lit(D(2023, 1, 2))))
    assert again.read(D(2023, 1, 1)).count() == 1  # earlier day kept
    assert again.read(D(2023, 1, 2)).count() == 1


def test_run_daily_rejects_empty_range(spark):
    with pytest.raises(ValueError, match="empty"):
        run_daily(spark, work_path(spark, "empty"), D(2023, 1, 3), D(2023, 1, 2), lambda p, d: p)


def test_empty_rerun_clears_the_day_and_empty_days_count_as_loaded(spark):
    from cumulo.streaming.daily import BucketedStore, PathStore
    d1 = spark.createDataFrame([(1, [D(2023, 1, 1)], D(2023, 1, 1))],
                               "user_id bigint, dates_active array<date>, snapshot_date date")
    none = d1.where("false")
    ev = spark.createDataFrame([(7, "2023-01-04 10:00:00")], "user_id bigint, ts string").withColumn("ts", F.to_timestamp("ts"))

    def step(prev, d):
        return cumulative.cumulate_dates(prev, cumulative.active_keys(ev, "user_id", "ts", d), "user_id", d)

    for name, store in (("b", BucketedStore(spark, "empty_days", work_path(spark, "empty_days_b"), "user_id", 4)),
                        ("p", PathStore(spark, work_path(spark, "empty_days_p")))):
        store.write(d1, D(2023, 1, 1))
        store.write(d1.withColumn("snapshot_date", F.lit(D(2023, 1, 2))), D(2023, 1, 2))
        assert store.read(D(2023, 1, 1)).count() == 1
        store.write(none, D(2023, 1, 1))  # the rerun finds nothing
        assert store.read(D(2023, 1, 1)).count() == 0 and store.read(D(2023, 1, 2)).count() == 1
        assert store.exists(D(2023, 1, 1)) and not store.exists(D(2022, 12, 31))
    # an empty seed, a day without events, then a day with one
    for store in (BucketedStore(spark, "empty_seed", work_path(spark, "empty_seed_b"), "user_id", 4),
                  PathStore(spark, work_path(spark, "empty_seed_p"))):
        store.write(none, D(2023, 1, 2))
        out = run_daily(spark, store, D(2023, 1, 3), D(2023, 1, 4), step)
        assert rows(out, "user_id", "dates_active") == [(7, [D(2023, 1, 4)])]


def test_bucket_count_follows_size(spark):
    from cumulo.streaming.daily import buckets_for
    df = spark.range(100)
    assert buckets_for(df) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert buckets_for(df, target_bytes=8) == 100


def test_long_form_equals_map(spark):
    ev = spark.createDataFrame([(1, "2023-01-01 10:00:00", None), (1, "2023-01-02 10:00:00", "x"), (2, "2023-01-02 10:00:00", None)],
                               "user_id bigint, ts string, b string").withColumn("ts", F.to_timestamp("ts"))
    got = rows(cumulative.rebuild_dates(ev.where("user_id is not null"), ["user_id", "b"], "ts", D(2023, 1, 2), drop_null_keys=False),
               "user_id", "b", "dates_active")
    assert got == sorted([(1, None, [D(2023, 1, 1)]), (1, "x", [D(2023, 1, 2)]), (2, None, [D(2023, 1, 2)])], key=repr)


def test_a_real_sub_key_named_like_null_is_refused(spark):
    import datetime as dt
    import pytest
    from pyspark.errors import PySparkException
    ev = spark.createDataFrame([(1, "unknown", dt.datetime(2024, 1, 1)), (1, None, dt.datetime(2024, 1, 2))], "user_id int, kind string, ts timestamp")
    with pytest.raises(PySparkException, match="name NULLs differently"):
        cumulative.rebuild_date_map(ev, "user_id", "kind", "ts", "2024-01-03").collect()
    with pytest.raises(PySparkException, match="name NULLs differently"):
        cumulative.active_pairs(ev, "user_id", "kind", "ts", "2024-01-01").collect()
    got = cumulative.rebuild_date_map(ev, "user_id", "kind", "ts", "2024-01-03", unknown="?").first()["device_activity_datelist"]
    assert got == {"unknown": [dt.date(2024, 1, 1)], "?": [dt.date(2024, 1, 2)]}
