"""Datelist bitsets (J7, J8, J28) and monthly arrays."""

import datetime as dt

from pyspark.sql import functions as F

from cumulo.functions.arrays import splice_slot
from cumulo.functions.bits import datelist_bits
from cumulo.operators import cumulative, datelist, metrics
from cumulo.plans.inspect import exchanges
from cumulo.sources.tables import read_table
from tests.conftest import SF_SMALL, rows

D = dt.date
AS_OF = D(2023, 1, 31)


def snap(spark, ages):
    """One user per case: active on ``AS_OF - age`` for each age."""
    data = [(name, [AS_OF - dt.timedelta(days=a) for a in a_list], AS_OF) for name, a_list in ages.items()]
    return spark.createDataFrame(data, "user_id string, dates_active array<date>, snapshot_date date")


CASES = {"today": [0], "yesterday": [1], "six": [6], "seven": [7], "twentynine": [29],
         "before": [40], "mixed": [0, 0, 3, 31]}


def test_datelist_flags_default(spark):
    out = {r["user_id"]: r for r in datelist.datelist(snap(spark, CASES), "user_id", AS_OF).collect()}
    assert out["today"]["datelist_int"] == 1 << 31
    assert out["today"]["datelist_bits"] == "1" + "0" * 31
    assert (out["today"]["dim_is_daily_active"], out["today"]["dim_is_weekly_active"]) == (True, True)
    assert out["yesterday"]["dim_is_daily_active"] is False and out["yesterday"]["dim_is_weekly_active"] is True
    assert out["six"]["dim_is_weekly_active"] is True
    assert out["seven"]["dim_is_weekly_active"] is False and out["seven"]["dim_is_monthly_active"] is True
    assert out["twentynine"]["datelist_int"] == 1 << 2
    assert out["before"]["datelist_int"] == 0 and out["before"]["dim_is_monthly_active"] is False
    assert out["mixed"]["datelist_int"] == (1 << 31) | (1 << 28) | 1  # duplicates OR-ed once


def test_datelist_compat_loses_today(spark):
    out = {r["user_id"]: r for r in
           datelist.datelist(snap(spark, CASES), "user_id", AS_OF, days=30, top_bit=32).collect()}
    assert out["today"]["datelist_int"] == 0 and out["today"]["dim_is_monthly_active"] is False
    assert out["yesterday"]["dim_is_daily_active"] is True  # the reference's shifted "daily"
    assert out["seven"]["dim_is_weekly_active"] is True
    assert out["twentynine"]["datelist_int"] == 1 << 3


def test_datelist_matches_cross_join_form(spark):
    """Brute force: cross join with a date series and sum powers of two."""
    ev = read_table(spark, SF_SMALL, "events")
    as_of = D(2024, 1, 30)
    s = cumulative.rebuild_dates(ev, "user_id", "ts", as_of)
    fast = datelist.datelist(s, "user_id", as_of).select("user_id", "datelist_int")
    series = spark.range(32).select(F.date_sub(F.lit(as_of), F.col("id").cast("int")).alias("d"))
    brute = (s.crossJoin(series)
              .select("user_id", F.when(F.array_contains("dates_active", F.col("d")),
                                        F.pow(F.lit(2), 31 - F.datediff(F.lit(as_of), F.col("d"))).cast("bigint"))
                                   .otherwise(0).alias("v"))
              .groupBy("user_id").agg(F.sum("v").alias("datelist_int")))
    assert rows(fast) == rows(brute)
    assert exchanges(fast.where(F.col("user_id").isNotNull())) <= 1  # only the snapshot's own aggregate


def test_datelist_on_snapshot_has_no_shuffle(spark):
    plan_df = datelist.datelist(snap(spark, CASES), "user_id", AS_OF)
    assert exchanges(plan_df) == 0


def test_datelist_map(spark):
    df = spark.createDataFrame([(1, {"a": [AS_OF], "b": [AS_OF - dt.timedelta(days=1)]})],
                               "user_id int, m map<string,array<date>>")
    got = datelist.datelist_map(df, "user_id", AS_OF, map_col="m").collect()[0]["datelist_int"]
    assert got == {"a": 1 << 31, "b": 1 << 30}


def test_splice_slot(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), (None,), ([5],)], "a array<bigint>")
    got = [r["x"] for r in df.select(splice_slot("a", 3, 9).alias("x")).collect()]
    assert got == [[1, 2, 9], [0, 0, 9], [0, 0, 9], [5, 0, 9]]
    got = [r["x"] for r in df.select(splice_slot("a", 2, 7).alias("x")).collect()]
    assert got == [[1, 7, 3], [0, 7], [0, 7], [5, 7]]


def hits_events(spark):
    data = [(1, "2023-01-01 01:00:00"), (1, "2023-01-01 02:00:00"), (2, "2023-01-07 05:00:00"),
            (1, "2023-01-08 05:00:00"), (None, "2023-01-08 06:00:00"), (3, "2023-02-01 00:00:00")]
    return spark.createDataFrame(data, "user_id bigint, ts string").withColumn("ts", F.to_timestamp("ts"))


def test_rebuild_metric(spark):
    ev = hits_events(spark)
    got = {r["user_id"]: r["metric_array"] for r in metrics.rebuild_metric(ev, "user_id", "ts", D(2023, 1, 8)).collect()}
    assert got == {1: [2, 0, 0, 0, 0, 0, 0, 1], 2: [0, 0, 0, 0, 0, 0, 1, 0]}


def test_append_metric_idempotent_and_month_change(spark):
    ev = hits_events(spark)

    def load(prev, d):
        daily = metrics.daily_values(ev, "user_id", "ts", d, {"value": F.count(F.lit(1))})
        return metrics.append_metric(prev, daily, "user_id", d, "value", "site_hits")

    empty = spark.createDataFrame([], "user_id bigint, month_start date, metric_name string, metric_array array<bigint>")
    state = empty
    for i in range(8):
        state = load(state, D(2023, 1, 1) + dt.timedelta(days=i)).cache()
    want = rows(metrics.rebuild_metric(ev, "user_id", "ts", D(2023, 1, 8)))
    assert rows(state) == want
    assert rows(load(state, D(2023, 1, 8))) == want  # rerun of day 8: same contents, no extra slot
    # skipped day: load day 10 after day 8 -> day 9 padded with zero
    got = {r["user_id"]: r["metric_array"] for r in load(state, D(2023, 1, 10)).collect()}
    assert got[1] == [2, 0, 0, 0, 0, 0, 0, 1, 0, 0]
    # month change starts new arrays
    feb = {r["user_id"]: r for r in load(state, D(2023, 2, 1)).collect()}
    assert feb[3]["metric_array"] == [1] and feb[3]["month_start"] == D(2023, 2, 1)
    assert set(feb) == {3}  # January's keys do not carry into February's arrays


def test_explode_metric_all_slots(spark):
    df = spark.createDataFrame(
        [(1, D(2023, 1, 1), "hits", [1, 2, 3, 4]), (2, D(2023, 1, 1), "hits", [1, 0, 0, 1])],
        "user_id int, month_start date, metric_name string, metric_array array<bigint>")
    got = rows(metrics.explode_metric(df))
    assert got == [("hits", D(2023, 1, 1), 2), ("hits", D(2023, 1, 2), 2), ("hits", D(2023, 1, 3), 3),
                   ("hits", D(2023, 1, 4), 5)]


def test_host_activity(spark):
    data = [("h", 1, "2023-01-01 01:00:00"), ("h", 1, "2023-01-01 02:00:00"), ("h", 2, "2023-01-01 03:00:00"),
            ("h", None, "2023-01-02 03:00:00"), ("g", 1, "2023-01-02 04:00:00")]
    ev = spark.createDataFrame(data, "host string, user_id bigint, ts string").withColumn("ts", F.to_timestamp("ts"))
    got = {r["host"]: (r["hit_array"], r["unique_visitors"])
           for r in metrics.rebuild_host_activity(ev, "host", "user_id", "ts", D(2023, 1, 2)).collect()}
    assert got == {"h": ([3, 1], [2, 0]), "g": ([0, 1], [0, 1])}


def test_datelist_bits_expression(spark):
    df = spark.createDataFrame([([AS_OF, AS_OF - dt.timedelta(days=31)],)], "d array<date>")
    assert df.select(datelist_bits("d", AS_OF).alias("b")).collect()[0]["b"] == (1 << 31) | 1


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_event = st.tuples(st.sampled_from([1, 2, 3, None]), st.integers(0, 9), st.integers(0, 23))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_event, min_size=1, max_size=30), st.integers(1, 10))
def test_daily_appends_equal_rebuild(spark, events, last):
    """Appending day by day (in any run length) equals the closed form."""
    data = [(u, f"2023-03-{d + 1:02d} {h:02d}:00:00") for u, d, h in events]
    ev = spark.createDataFrame(data, "user_id bigint, ts string").withColumn("ts", F.to_timestamp("ts"))
    state = spark.createDataFrame([], "user_id bigint, month_start date, metric_name string, "
                                      "metric_array array<bigint>")
    for i in range(last):
        d = D(2023, 3, 1) + dt.timedelta(days=i)
        daily = metrics.daily_values(ev, "user_id", "ts", d, {"value": F.count(F.lit(1))})
        state = metrics.append_metric(state, daily, "user_id", d, "value", "site_hits").cache()
    want = rows(metrics.rebuild_metric(ev, "user_id", "ts", D(2023, 3, 1) + dt.timedelta(days=last - 1)))
    assert rows(state) == want


def test_append_metrics_keeps_one_null_key_row(spark):
    data = [(None, 1, "2023-01-01 01:00:00"), (None, 2, "2023-01-02 01:00:00"), ("h", 1, "2023-01-02 02:00:00")]
    ev = spark.createDataFrame(data, "host string, user_id bigint, ts string").withColumn("ts", F.to_timestamp("ts"))
    seed = metrics.rebuild_host_activity(ev, "host", "user_id", "ts", D(2023, 1, 1))
    daily = metrics.daily_values(ev, "host", "ts", D(2023, 1, 2),
                                 {"hits": F.count(F.lit(1)), "uv": F.count_distinct("user_id")}, drop_null_keys=False)
    out = metrics.append_metrics(seed, daily, "host", D(2023, 1, 2),
                                 {"hit_array": "hits", "unique_visitors": "uv"}, null_safe_key=True)
    assert rows(out) == rows(metrics.rebuild_host_activity(ev, "host", "user_id", "ts", D(2023, 1, 2)))
    assert len([r for r in out.collect() if r["host"] is None]) == 1


def test_fractions_stay_and_both_forms_agree(spark):
    ev = spark.createDataFrame([(1, "2023-01-01 01:00:00", 0.5), (1, "2023-01-01 02:00:00", 0.5), (1, "2023-01-02 01:00:00", 2.5)],
                               "user_id bigint, ts string, v double").withColumn("ts", F.to_timestamp("ts"))
    closed = metrics.rebuild_metric(ev, "user_id", "ts", D(2023, 1, 2), "revenue", F.col("v"))
    assert closed.collect()[0]["metric_array"] == [1.0, 2.5]
    state = metrics.rebuild_metric(ev, "user_id", "ts", D(2023, 1, 1), "revenue", F.col("v"))
    daily = metrics.daily_values(ev, "user_id", "ts", D(2023, 1, 2), {"value": F.sum("v")})
    assert rows(metrics.append_metric(state, daily, "user_id", D(2023, 1, 2), "value", "revenue")) == rows(closed)
    assert closed.schema["metric_array"].dataType.simpleString() == "array<double>"


def test_several_metrics_in_one_table(spark):
    import pytest
    prev = spark.createDataFrame([(1, D(2023, 1, 1), "hits", [2.0]), (1, D(2023, 1, 1), "rev", [0.5])],
                                 "user_id bigint, month_start date, metric_name string, metric_array array<double>")
    daily = spark.createDataFrame([(1, "rev", 1.5), (2, "hits", 1.0)], "user_id bigint, metric_name string, value double")
    got = rows(metrics.append_metric(prev, daily, "user_id", D(2023, 1, 2)), "user_id", "metric_name", "metric_array")
    assert got == sorted([(1, "hits", [2.0, 0.0]), (1, "rev", [0.5, 1.5]), (2, "hits", [0.0, 1.0])], key=repr)
    with pytest.raises(ValueError, match="name the metric"):
        metrics.append_metric(prev, daily.drop("metric_name"), "user_id", D(2023, 1, 2))


def test_metrics_of_one_day_replace_only_their_part(spark):
    from cumulo.sources.session import work_path
    from cumulo.streaming.daily import BucketedStore, PathStore
    schema = "user_id bigint, month_start date, metric_name string, metric_array array<double>, date_partition date"
    row = lambda m, v: spark.createDataFrame([(1, D(2023, 1, 1), m, [v], D(2023, 1, 1))], schema)
    for store in (BucketedStore(spark, "two_metrics", work_path(spark, "two_metrics_b"), "user_id", 4, "date_partition", ("metric_name",)),
                  PathStore(spark, work_path(spark, "two_metrics_p"), "date_partition", ("metric_name",))):
        for m, v in (("hits", 1.0), ("rev", 0.5), ("rev", 0.75)):
            store.write(row(m, v), D(2023, 1, 1), metric_name=m)
        assert rows(store.read(D(2023, 1, 1)), "metric_name", "metric_array") == [("hits", [1.0]), ("rev", [0.75])]


def test_explode_metric_takes_arrays_of_any_length(spark):
    df = spark.createDataFrame([(1, D(2023, 1, 1), "m", [1.5] * 40)],
                               "user_id int, month_start date, metric_name string, metric_array array<double>")
    got = metrics.explode_metric(df).collect()
    assert len(got) == 40 and sum(r["value"] for r in got) == 60.0
