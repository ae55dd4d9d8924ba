"""Rolling bitsets, distinct sets, late rows, bucket growth, interval store."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cumulo.functions import bitsets
from cumulo.operators import cumulative, distinct_sets, history, metrics, rolling
from cumulo.plans.inspect import exchanges, session_conf
from cumulo.sources.session import checkpoint_root, work_path
from cumulo.streaming.daily import BucketedStore, PathStore, run_daily
from cumulo.streaming.intervals import IntervalStore
from cumulo.streaming.late import apply_late_dates, apply_late_values
from tests.conftest import rows

DAY = dt.date(2024, 1, 1)


def events(spark, seed=1, users=40, days=20, n=600):
    rng = random.Random(seed)
    data = [(rng.choice([None, *range(users)]), dt.datetime(2024, 1, 1 + rng.randrange(days), rng.randrange(24)), rng.randrange(100)) for _ in range(n)]
    return spark.createDataFrame(data, "user_id bigint, ts timestamp, value int")


# --- bitsets -----------------------------------------------------------------

@pytest.mark.parametrize("days,by", [(365, 1), (365, 64), (365, 100), (70, 1), (64, 63), (1, 1), (32, 0)])
def test_shift_and_set_against_sets_of_ages(spark, days, by):
    rng = random.Random(days + by)
    ages = [sorted(rng.sample(range(days), min(days, k))) for k in (0, 1, 5, 60)]
    pack = lambda xs: [sum(1 << (63 - a % 64) for a in xs if a // 64 == k) for k in range(bitsets.words_for(days))]
    signed = lambda ws: [w - (1 << 64) if w >> 63 else w for w in ws]
    df = spark.createDataFrame([(i, signed(pack(a)), rng.randrange(-2, days + 3)) for i, a in enumerate(ages)], "i int, b array<bigint>, age int")
    got = df.select("i", "age", bitsets.shift("b", by, days).alias("s"), bitsets.with_age("b", "age", days).alias("w"),
                    bitsets.count_days("b", min(7, days)).alias("n"), bitsets.count_days("b", days, min(3, days - 1)).alias("m"),
                    bitsets.recent32("b").alias("r"), bitsets.is_idle("b").alias("idle")).collect()
    for r in got:
        a = set(ages[r["i"]])
        assert r["s"] == signed(pack(sorted(x + by for x in a if x + by < days)))
        assert r["w"] == signed(pack(sorted(a | ({r["age"]} if 0 <= r["age"] < days else set()))))
        assert r["n"] == len([x for x in a if x < 7]) and r["m"] == len([x for x in a if min(3, days - 1) <= x])
        assert r["r"] == sum(1 << (31 - x) for x in a if x < 32) and r["idle"] == (not a)


def test_rolling_state_equals_rebuild_and_forgets(spark):
    ev = events(spark)
    seed = rolling.rebuild_bits(ev, "user_id", "ts", DAY + dt.timedelta(days=4), days=10)
    store = PathStore(spark, work_path(spark, "rolling"))
    store.write(seed, DAY + dt.timedelta(days=4))
    end = DAY + dt.timedelta(days=25)
    run_daily(spark, store, DAY + dt.timedelta(days=5), end, lambda prev, d: rolling.roll_bits(
        prev, cumulative.active_keys(ev, "user_id", "ts", d), "user_id", d, days=10))
    for n in (5, 12, 20, 25):
        d = DAY + dt.timedelta(days=n)
        want = rolling.rebuild_bits(ev, "user_id", "ts", d, days=10)
        assert rows(store.read(d).select("user_id", "activity")) == rows(want.select("user_id", "activity"))
    gone = DAY + dt.timedelta(days=40)
    state = store.read(end).withColumn("snapshot_date", F.lit(end))
    assert rolling.roll_bits(state, ev.select("user_id").limit(0), "user_id", gone, days=10, gap=15).count() == 0


def test_rolling_state_keeps_a_null_key(spark):
    ev = events(spark)
    a, b = DAY + dt.timedelta(days=8), DAY + dt.timedelta(days=9)
    prev = rolling.rebuild_bits(ev, "user_id", "ts", a, drop_null_keys=False)
    got = rolling.roll_bits(prev, cumulative.active_keys(ev, "user_id", "ts", b, drop_null_keys=False), "user_id", b, null_safe_key=True)
    assert rows(got) == rows(rolling.rebuild_bits(ev, "user_id", "ts", b, drop_null_keys=False))


def test_rolling_state_is_not_shuffled_when_bucketed(spark):
    ev = events(spark)
    store = BucketedStore(spark, "rolling_plan", work_path(spark, "rolling_plan"), "user_id", 8)
    store.write(rolling.rebuild_bits(ev, "user_id", "ts", DAY), DAY)
    d = DAY + dt.timedelta(days=1)
    with store.planning(), session_conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        step = rolling.roll_bits(store.read(DAY), cumulative.active_keys(ev, "user_id", "ts", d), "user_id", d)
        assert exchanges(step) == 1  # today's keys
    store.release(DAY)


# --- distinct sets -------------------------------------------------------------

@pytest.mark.parametrize("sparse", [0, 3, 100_000])
def test_sets_merge_to_distinct_counts(spark, monkeypatch, sparse):
    monkeypatch.setattr(distinct_sets, "SPARSE", sparse)
    rng = random.Random(4)
    ids = [0, 1, -1, -40_000, 32_767, 32_768, 32_769, 70_000, 10**15, None] + list(range(200, 260))
    data = [(rng.choice(["a", "b", None]), rng.choice(ids), dt.datetime(2024, 1, 1 + rng.randrange(9))) for _ in range(800)]
    ev = spark.createDataFrame(data, "host string, user_id bigint, ts timestamp")
    sets = distinct_sets.daily_sets(ev, "host", "user_id", "ts")
    got = {r["host"]: r["n_members"] for r in distinct_sets.count_members(sets, "host").collect()}
    assert got == {h: len({u for x, u, _ in data if x == h and u is not None}) for h in ("a", "b", None)}
    some = sets.where(F.col("date_partition") < F.lit(dt.date(2024, 1, 4)))
    assert {r["host"]: r["n_members"] for r in distinct_sets.count_members(some, "host").collect()} == {
        h: len({u for x, u, t in data if x == h and u is not None and t.day < 4}) for h in ("a", "b", None)}
    assert distinct_sets.count_members(distinct_sets.daily_sets(ev.limit(0), "host", "user_id", "ts"), "host").count() == 0


def test_a_rerun_day_replaces_its_sets(spark):
    ev = events(spark)
    store = PathStore(spark, work_path(spark, "sets"), "date_partition")
    for _ in range(2):
        for n in range(20):
            d = DAY + dt.timedelta(days=n)
            store.write(distinct_sets.daily_sets(ev, [], "user_id", "ts", d, d), d)
    got = distinct_sets.count_members(spark.read.parquet(store.path).withColumn("all", F.lit(1)), "all").collect()
    assert [r["n_members"] for r in got] == [ev.select("user_id").dropna().distinct().count()]


# --- late rows -----------------------------------------------------------------

@pytest.mark.parametrize("kind", ["path", "bucketed"])
@pytest.mark.parametrize("null_key", [False, True])
def test_late_dates_equal_the_rebuild_and_leave_earlier_days(spark, kind, null_key):
    checkpoint_root(spark)
    ev = events(spark).withColumn("late", (F.dayofmonth("ts").isin(3, 5)) & (F.col("value") < 60))
    on_time, late = ev.where(~F.col("late")), ev.where("late")
    end, name = DAY + dt.timedelta(days=7), f"late_{kind}_{null_key}"
    store = (PathStore(spark, work_path(spark, name)) if kind == "path"
             else BucketedStore(spark, name, work_path(spark, name), "user_id", 4))
    store.write(cumulative.rebuild_dates(on_time, "user_id", "ts", DAY, drop_null_keys=not null_key), DAY)
    run_daily(spark, store, DAY + dt.timedelta(days=1), end, lambda prev, d: cumulative.cumulate_dates(
        prev, cumulative.active_keys(on_time, "user_id", "ts", d, drop_null_keys=not null_key), "user_id", d, null_safe_key=null_key))
    files = lambda d: sorted(r[0] for r in store.read(d).select(F.col("_metadata.file_path")).distinct().collect())
    before = files(DAY + dt.timedelta(days=1))
    done = apply_late_dates(store, late, "user_id", "ts", end, null_safe_key=null_key)
    assert done == [dt.date(2024, 1, n) for n in range(3, 9)]  # the second of January stays
    assert files(DAY + dt.timedelta(days=1)) == before
    for _ in range(2):  # applying them again changes nothing
        for d in done:
            want = cumulative.rebuild_dates(ev, "user_id", "ts", d, drop_null_keys=not null_key)
            assert rows(store.read(d).select("user_id", "dates_active")) == rows(want.select("user_id", "dates_active"))
        apply_late_dates(store, late, "user_id", "ts", end, null_safe_key=null_key)
    assert apply_late_dates(store, late.limit(0), "user_id", "ts", end) == []
    if kind == "bucketed":
        store.release(end)


def test_late_values_set_their_slots_and_leave_other_metrics(spark):
    checkpoint_root(spark)
    ev = events(spark).where("user_id is not null").withColumn("late", (F.dayofmonth("ts") == 4) & (F.col("value") < 60))
    on_time, late = ev.where(~F.col("late")), ev.where("late")
    end = DAY + dt.timedelta(days=6)
    store = BucketedStore(spark, "late_values", work_path(spark, "late_values"), "user_id", 4, "date_partition", ("metric_name",))
    for n in range(7):
        d = DAY + dt.timedelta(days=n)
        for name in ("hits", "other"):
            one = metrics.rebuild_metric(on_time, "user_id", "ts", d, name).withColumn("date_partition", F.lit(d))
            store.write(one, d, metric_name=name)
    files = lambda name: sorted(r[0] for r in spark.table("late_values").where(F.col("metric_name") == name).select(F.col("_metadata.file_path")).distinct().collect())
    other = files("other")

    def recompute(keys, d):
        return metrics.daily_values(ev.join(keys, "user_id", "left_semi"), "user_id", "ts", d, {"value": F.count(F.lit(1))})

    for _ in range(2):
        done = apply_late_values(store, late, recompute, "user_id", "ts", end, {"metric_array": "value"}, metric_name="hits")
        assert done == [dt.date(2024, 1, n) for n in range(4, 8)]
        for n in range(7):
            d = DAY + dt.timedelta(days=n)
            got = store.read(d).where("metric_name = 'hits'").select("user_id", "month_start", "metric_array")
            assert rows(got) == rows(metrics.rebuild_metric(ev, "user_id", "ts", d).select("user_id", "month_start", "metric_array"))
    assert files("other") == other
    store.release(end)


# --- bucket growth ---------------------------------------------------------------

def test_buckets_split_without_a_shuffle(spark):
    ev = spark.range(0, 20_000).select(F.col("id").alias("user_id"), F.lit(dt.datetime(2024, 1, 1)).alias("ts"))
    store = BucketedStore(spark, "grow", work_path(spark, "grow"), "user_id", 4)
    store.write(cumulative.rebuild_dates(ev, "user_id", "ts", DAY), DAY)
    assert store.refined(DAY) is store  # small enough
    with session_conf(spark, **{"spark.sql.shuffle.partitions": "64"}):
        assert exchanges(store.split(DAY, 8)) == 0
    size = store.bytes_per_bucket(DAY)
    finer = store.refined(DAY, size // 3)
    assert finer.n == 16 and rows(finer.read(DAY)) == rows(store.read(DAY))
    assert finer.refined(DAY, size // 3) is finer or finer.bytes_per_bucket(DAY) > size // 3
    d = DAY + dt.timedelta(days=1)
    today = ev.where("user_id % 3 = 0").select("user_id")
    with finer.planning(), session_conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        step = cumulative.cumulate_dates(finer.read(DAY), today, "user_id", d)
        assert exchanges(step) == 1  # today's keys only
    finer.write(cumulative.cumulate_dates(finer.read(DAY), today, "user_id", d), d)
    assert finer.read(d).count() == 20_000 and store.read(DAY).count() == 20_000
    with pytest.raises(ValueError):
        store.split(DAY, 6)
    for s in (store, finer):
        s.release(DAY)


# --- interval store --------------------------------------------------------------

def seasons(spark, seed=3):
    rng = random.Random(seed)
    data = [(p, s, rng.choice(["a", "b", None])) for p in [None, *range(30)] for s in range(1990, 2002) if rng.random() < 0.7]
    return spark.createDataFrame(data, "player bigint, season int, class string")


def test_daily_intervals_equal_scd2_and_closed_parts_stay(spark):
    checkpoint_root(spark)
    df = seasons(spark)
    store = IntervalStore(spark, work_path(spark, "runs"), "player", "season", "class")
    seen = {}
    for s in range(1990, 2002):
        store.load(df.where(F.col("season") == s), s)
        closed = store.closed_rows()
        if closed is not None:
            now = {}
            for r in closed.select("closed_by", F.col("_metadata.file_path").alias("f")).distinct().collect():
                now.setdefault(r["closed_by"], set()).add(r["f"])
            assert all(now[k] == v for k, v in seen.items())  # written once
            seen = now
        want = history.scd2(df.where(F.col("season") <= s), "player", "season", "class")
        assert rows(store.history()) == rows(want)
    store.load(df.where("season = 2001"), 2001)  # the last load again
    assert rows(store.history()) == rows(history.scd2(df, "player", "season", "class"))
    with pytest.raises(ValueError):
        store.load(df.where("season = 1995"), 1995)


def test_a_late_season_splits_runs_of_its_players_only(spark):
    checkpoint_root(spark)
    df = seasons(spark)
    late = (F.col("season") == 1995) & (F.pmod(F.coalesce("player", F.lit(0)), F.lit(3)) == 0)
    on_time = df.where(~late)
    store = IntervalStore(spark, work_path(spark, "late_runs"), "player", "season", "class")
    for s in range(1990, 2002):
        store.load(on_time.where(F.col("season") == s), s)
    done = store.load_late(df, df.where(late).select("player"))
    assert done and all(int(x) >= 1995 for x in done)
    assert rows(store.history()) == rows(history.scd2(df, "player", "season", "class"))
    assert store.load_late(df, df.where(late).select("player")) == []  # nothing left to change
    assert rows(store.history()) == rows(history.scd2(df, "player", "season", "class"))
