"""Regression tests for review findings."""

import datetime as dt

from pyspark.sql import functions as F

from cumulo.operators import datelist, devices, facts, joins
from cumulo.plans.inspect import physical_plan, session_conf
from tests.conftest import rows

D = dt.date


def test_shuffle_strategy_is_forced_even_for_tiny_tables(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 10)
    small = spark.range(10).withColumnRenamed("id", "k")
    got = joins.join_strategies(big, small, "k")
    assert got["shuffle"] == "SortMergeJoin" and got["broadcast"] == "BroadcastHashJoin"


def test_broadcast_limit_parses_size_strings(spark):
    df = spark.range(1)
    with session_conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "50MB"}):
        assert joins.broadcast_limit(df) == 50 * 1024 * 1024
    with session_conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert joins.broadcast_limit(df) < 0  # switched off stays off
        assert joins.maybe_broadcast(df) is df


def test_datelist_map_reads_only_as_of_snapshot(spark):
    snap = spark.createDataFrame(
        [(1, {"a": [D(2023, 1, 30)]}, D(2023, 1, 30)), (1, {"a": [D(2023, 1, 31), D(2023, 1, 30)]}, D(2023, 1, 31))],
        "user_id int, device_activity_datelist map<string,array<date>>, snapshot_date date")
    got = datelist.datelist_map(snap, "user_id", D(2023, 1, 31)).collect()
    assert len(got) == 1 and got[0]["datelist_int"] == {"a": (1 << 31) | (1 << 30)}


def test_datelist_accepts_column_as_of(spark):
    snap = spark.createDataFrame([(1, [D(2023, 1, 31)], D(2023, 1, 31))],
                                 "user_id int, dates_active array<date>, snapshot_date date")
    got = datelist.datelist(snap, "user_id", F.to_date(F.lit("2023-01-31"))).collect()
    assert got[0]["datelist_int"] == 1 << 31


def test_build_fact_dedup_after_join_with_shared_names(spark):
    details = spark.createDataFrame([(1, "x", 5), (1, "x", 3), (2, "y", 7)], "k int, x string, v int")
    parents = spark.createDataFrame([(1, 10), (2, 20)], "k int, pv int")
    out = facts.build_fact(details, parents, "k", "k", ["x"],
                           {"x": details["x"], "v": details["v"], "pv": parents["pv"]})
    assert rows(out) == [("x", 3, 10), ("y", 7, 20)]
    assert "Window" in physical_plan(out)


def test_user_devices_null_device(spark):
    ev = spark.createDataFrame([(1, 7, "a"), (1, None, "b")], "user_id bigint, device_id bigint, host string")
    r = devices.user_devices(devices.events_by_device(ev)).collect()
    assert sorted((x["device_id"] or 0, x["device_hits"], x["num_devices"], x["total_hits"]) for x in r) == [
        (0, 1, 1, 2), (7, 1, 1, 2)]


def test_idle_key_with_null_history_is_not_marked_active(spark):
    from cumulo.operators import cumulative
    prev = spark.createDataFrame([(1, None, D(2023, 1, 1)), (2, [D(2023, 1, 1)], D(2023, 1, 1))],
                                 "user_id bigint, dates_active array<date>, snapshot_date date")
    today = spark.createDataFrame([(2,), (3,)], "user_id bigint")
    got = {r["user_id"]: r["dates_active"] for r in
           cumulative.cumulate_dates(prev, today, "user_id", D(2023, 1, 2)).collect()}
    assert got == {1: None, 2: [D(2023, 1, 2), D(2023, 1, 1)], 3: [D(2023, 1, 2)]}


def test_build_fact_grain_column_on_parent_side(spark):
    details = spark.createDataFrame([(1, 5), (1, 3), (2, 7)], "game_id int, v int")
    parents = spark.createDataFrame([(1, 10), (2, 10)], "g_id int, season int")
    out = facts.build_fact(details, parents, "game_id", "g_id", ["season"],
                           {"season": parents["season"], "v": details["v"]})
    assert rows(out) == [(10, 3)]


def test_parse_bytes():
    assert joins.parse_bytes("10MB") == 10 << 20
    assert joins.parse_bytes("1g") == 1 << 30
    assert joins.parse_bytes("10485760") == 10485760
    assert joins.parse_bytes("-1") == -1


def test_bucketed_store_ignores_empty_leftover_folder(spark):
    import os
    from cumulo.sources.session import work_path
    from cumulo.streaming.daily import BucketedStore
    path = work_path(spark, "leftover")
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    store = BucketedStore(spark, "leftover_t", path, "user_id", 4)
    assert not store.exists(D(2023, 1, 1))
    d1 = spark.createDataFrame([(1, [D(2023, 1, 1)], D(2023, 1, 1))],
                               "user_id bigint, dates_active array<date>, snapshot_date date")
    store.write(d1)
    assert store.read(D(2023, 1, 1)).count() == 1


def test_run_table_job_refuses_in_place_overwrite(spark):
    import pytest
    import uuid
    from cumulo.sources import catalog
    from cumulo.sources.session import work_path
    db = f"cumulo_inplace_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, db, location=work_path(spark, db))
    spark.range(3).write.saveAsTable(f"{db}.t")
    with pytest.raises(ValueError, match="read by the job"):
        catalog.run_table_job(spark, f"{db}.t", lambda df: df, f"{db}.t")
