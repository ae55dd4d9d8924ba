"""Joins, rankings and physical layouts (J17-J26, J32) with plan checks."""

from pyspark.sql import functions as F

from cumulo.operators import devices, joins, ranking
from cumulo.plans import layout
from cumulo.plans.inspect import exchanges, physical_plan, session_conf
from cumulo.sources.session import work_path
from cumulo.sources.tables import read_table
from tests.conftest import SF_SMALL, rows


def test_user_devices_no_fan_out(spark):
    ev = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 11, "a"), (2, 12, "c"), (None, 13, "d")],
                               "user_id bigint, device_id bigint, host string")
    by_dev = devices.events_by_device(ev)
    assert rows(by_dev) == [(1, 10, 2, ["a", "b"]), (1, 11, 1, ["a"]), (2, 12, 1, ["c"])]
    got = rows(devices.user_devices(by_dev))
    # user 1: 2 devices, 3 events -> devices listed once each
    assert got == [(1, 10, 2, 3, 2, 2), (1, 11, 1, 3, 2, 2), (2, 12, 1, 1, 1, 1)]


def test_rankings_ties_and_missing_medals(spark):
    df = spark.createDataFrame([
        ("m1", "p1", 10, 1), ("m1", "p1", 12, 2),   # duplicate (match, player): first by order counts once
        ("m1", "p2", 8, 1), ("m2", "p2", 10, 1), ("m2", "p1", 8, 1),
    ], "match_id string, player string, kills int, line int")
    top = ranking.top_by_mean(df, "player", "match_id", "kills", order_by=[F.col("line").asc()])
    assert [tuple(r) for r in top.collect()] == [("p1", 9.0)]  # tie at 9.0 broken by key
    units = ranking.top_by_units(df, "player", "match_id", k=2)
    assert [tuple(r) for r in units.collect()] == [("p1", 2), ("p2", 2)]
    medals = spark.createDataFrame([("map1", "Spree", 3), ("map2", "Other", 9), ("map2", "Spree", 3)],
                                   "mapid string, medal string, cnt int")
    best = ranking.top_by_sum(medals, "mapid", "cnt", where=F.col("medal") == "Spree")
    assert [tuple(r) for r in best.collect()] == [("map1", 3)]


def test_broadcast_join_plans(spark):
    big = read_table(spark, SF_SMALL, "lineitem")
    small = read_table(spark, SF_SMALL, "part").withColumnRenamed("p_partkey", "l_partkey")
    with session_conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        hinted = physical_plan(joins.join_small(big, small, "l_partkey", strategy="broadcast", max_bytes=1 << 20))
        plain = physical_plan(joins.join_small(big, small, "l_partkey", strategy="shuffle"))
        capped = physical_plan(joins.join_small(big, small, "l_partkey", max_bytes=10))
    assert "BroadcastHashJoin" in hinted
    assert "SortMergeJoin" in plain
    assert "SortMergeJoin" in capped  # estimate above the cap: no broadcast


def test_stage_map_medals_keeps_every_medal_row(spark):
    maps = spark.createDataFrame([(1, "m", "d")], "mapid long, name string, description string")
    matches = spark.createDataFrame([(100, 1, "pl"), (101, 1, "pl"), (102, 2, "pl")],
                                    "match_id long, mapid long, playlist_id string")
    mmp = spark.createDataFrame([(100, "p", 5, 1), (100, "q", 6, 2), (102, "p", 5, 1), (999, "z", 5, 1)],
                                "match_id long, player_gamertag string, medal_id long, count int")
    out = joins.stage_map_medals(maps, matches, mmp)
    assert out.count() == 2  # match 102 has no known map, 999 no match


def test_bucket_join_has_no_shuffle(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    o = read_table(spark, SF_SMALL, "orders").withColumnRenamed("o_orderkey", "k")
    a = layout.write_bucketed(o, 16, "k")
    b = layout.write_bucketed(li.withColumnRenamed("l_orderkey", "k").select("k", "l_quantity"), 16, "k")
    # third table: one row per key (a per-key aggregate), so the 3-way join forms no pairs
    c = layout.write_bucketed(li.groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("n")), 16, "k")
    with session_conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        two = layout.bucket_join(spark, [a, b], "k")
        three = layout.bucket_join(spark, [a, b, c], "k")
        assert exchanges(two) == 0
        assert exchanges(three) == 0
        agg = spark.table(b).groupBy("k").agg(F.sum("l_quantity"))
        assert exchanges(agg) == 0
        plain = o.join(li.withColumnRenamed("l_orderkey", "k"), "k")
        assert exchanges(plain) == 2
    assert two.count() == li.join(o, li.l_orderkey == o.k).count()


def test_sort_exchange_counts(spark):
    ev = read_table(spark, SF_SMALL, "events")
    assert exchanges(layout.sort_local(ev, ["event_type", "ts"], n=10, part_cols=["event_type"])) == 1
    assert exchanges(layout.sort_global(ev.repartition(10, "event_type"), ["event_type", "ts"])) == 2
    assert exchanges(layout.sort_local(ev, ["event_type", "ts"])) == 0
    assert exchanges(layout.sort_global(ev, ["event_type", "ts"])) == 1


def test_layout_report_and_content(spark):
    ev = read_table(spark, SF_SMALL, "events").withColumn("event_date", F.to_date("ts"))
    base = work_path(spark, "layout_test")
    p1 = layout.write_layout(ev, f"{base}/sorted", ["event_date", "event_type"], n=4, cluster_cols=["event_date"])
    p2 = layout.write_layout(ev, f"{base}/plain", None, n=4, cluster_cols=["event_date"])
    rep = {r["layout"]: r for r in layout.layout_report(spark, {"sorted": p1, "plain": p2}).collect()}
    assert set(rep) == {"sorted", "plain"}
    assert all(r["size"] > 0 and r["num_files"] >= 1 for r in rep.values())
    assert spark.read.parquet(p1).count() == ev.count()
    cmp = layout.compare_layouts(ev, {"a": ["event_type"], "b": ["user_id"]}, n=2)
    assert cmp.count() == 2


def test_device_reports_share_one_persisted_aggregate(spark):
    from cumulo.plans.inspect import persisted
    from cumulo.sources import standins
    ev = standins.activity_events(read_table(spark, SF_SMALL, "events"))
    with persisted(devices.events_by_device(ev)) as by_dev:
        n_pairs = by_dev.count()
        per_user = devices.user_devices(by_dev)
        assert "InMemoryTableScan" in physical_plan(per_user)
        assert per_user.count() == n_pairs
    assert not by_dev.is_cached


def test_user_devices_has_one_shape_for_any_number_of_devices(spark):
    ev = spark.range(0, 5000).select((F.col("id") % 2).alias("user_id"), F.col("id").alias("device_id"))
    out = devices.user_devices(devices.device_counts(ev)).collect()
    assert sorted(r["device_id"] for r in out) == list(range(5000))  # every device exactly once
    assert {(r["num_devices"], r["total_hits"], r["device_hits"]) for r in out} == {(2500, 2500, 1)}


def test_user_devices_query_scans_events_once(spark):
    import __spark_entry__ as E
    plan = physical_plan(E.queries()["user_devices"](spark, SF_SMALL))
    assert "events.parquet" not in plan and "events_aggregated_staging" in plan


def test_join_strategies_and_layout_table(spark):
    big = read_table(spark, SF_SMALL, "lineitem")
    small = read_table(spark, SF_SMALL, "part").withColumnRenamed("p_partkey", "l_partkey")
    with session_conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "10MB"}):
        got = joins.join_strategies(big, small, "l_partkey")
    assert got == {"broadcast": "BroadcastHashJoin", "shuffle": "SortMergeJoin", "auto": "BroadcastHashJoin"}
    with session_conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):  # switched off: no hint
        assert set(joins.join_strategies(big, small, "l_partkey").values()) == {"SortMergeJoin"}
    import uuid
    name = f"events_sorted_{uuid.uuid4().hex[:8]}"
    ev = read_table(spark, SF_SMALL, "events").withColumn("event_date", F.to_date("ts"))
    layout.write_layout(ev, work_path(spark, name), ["event_date", "event_type"], cluster_cols=["event_date"],
                        table=name)
    assert spark.table(name).count() == ev.count()


def _files(spark, path):
    """Rows per file in file order: (file, [values])."""
    got = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_f"),
                                          F.col("_metadata.row_index").alias("_i")).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r["_f"], r["_i"])):
        out.setdefault(r["_f"], []).append(r)
    return out


def test_sort_global_is_a_total_order(spark):
    import __spark_entry__ as E
    path = work_path(spark, "sorted_global")
    with session_conf(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        E.queries()["sort_global"](spark, SF_SMALL).write.parquet(path)
    keys = [[(str(r["o_orderdate"]), r["o_orderkey"]) for r in rs] for rs in _files(spark, path).values()]
    assert len(keys) > 1
    assert all(k == sorted(k) for k in keys)
    ranges = sorted((k[0], k[-1]) for k in keys)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))  # files don't overlap


def test_sort_local_orders_each_file_and_fills_partitions(spark):
    import __spark_entry__ as E
    path = work_path(spark, "sorted_local")
    with session_conf(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        E.queries()["sort_local"](spark, SF_SMALL).write.parquet(path)
    files = _files(spark, path)
    for rs in files.values():
        k = [(r["o_orderpriority"] or "", str(r["o_orderdate"])) for r in rs]
        assert k == sorted(k)
    assert len(files) >= int(spark.conf.get("spark.sql.shuffle.partitions")) - 1  # more than priorities


def test_bucketed_write_has_a_file_per_bucket_and_leaves_no_table(spark):
    import os
    import __spark_entry__ as E
    before = {t.name for t in spark.catalog.listTables()}
    df = spark.range(0, 5000, numPartitions=20).withColumnRenamed("id", "k")
    t = layout.write_bucketed(df, 16, "k")
    path = spark.sql(f"DESCRIBE TABLE EXTENDED {t}").where("col_name = 'Location'").collect()[0][1].replace("file:", "")
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) <= 16
    layout.drop_bucketed(spark, [t])
    assert not os.path.exists(path)
    for q in ("bucket_join", "cumulate_users", "metric_two_incremental"):
        E.queries()[q](spark, SF_SMALL).count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_layout_check_finds_disorder(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int").coalesce(1)
    base = work_path(spark, "disorder")
    a = layout.write_layout(df, f"{base}/a")
    b = layout.write_layout(df, f"{base}/b", ["k"])
    got = {r["layout"]: r["num_unsorted"] for r in layout.layout_check(spark, {"a": (a, ["k"]), "b": (b, ["k"])}).collect()}
    assert got == {"a": 1, "b": 0}


def test_top_map_medal_filters_medals_in_the_scan(spark):
    import __spark_entry__ as E
    plan = physical_plan(E.queries()["top_map_medal"](spark, SF_SMALL))
    assert "EqualTo(p_type,ECONOMY)" in plan and "stg_maps_medals" not in plan
