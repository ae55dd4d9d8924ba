"""Sources and sinks: CSV readers, catalog DDL, append / partition overwrite."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from cumulo.operators import quality
from cumulo.sources import catalog
from cumulo.sources.session import work_path
from cumulo.sources.tables import date_series, read_csv, read_table, register_views
from tests.conftest import SF_SMALL


def test_csv_readers(spark):
    path = work_path(spark, "csv")
    nat = read_table(spark, SF_SMALL, "nation")
    nat.write.option("header", "true").csv(path)
    plain = read_csv(spark, path)
    assert all(t == "string" for _, t in plain.dtypes)
    inferred = read_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["n_nationkey"] == "int"
    typed = read_csv(spark, path, schema="n_nationkey int, n_name string, n_regionkey int")
    assert typed.count() == nat.count()


def test_views_and_series(spark):
    register_views(spark, SF_SMALL, ["region"])
    assert spark.sql("SELECT count(*) AS c FROM region").collect()[0]["c"] == 5
    s = date_series(spark, "2023-01-02", "2023-01-31")
    got = [r["series_date"] for r in s.orderBy("series_date").collect()]
    assert len(got) == 30 and got[0] == dt.date(2023, 1, 2) and got[-1] == dt.date(2023, 1, 31)


def test_reference_tables_and_write_modes(spark):
    db = f"cumulo_db_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, db, location=work_path(spark, db))
    t = catalog.create_reference_table(spark, "users_cumulated", f"{db}.users_cumulated")
    day1 = spark.createDataFrame([(1, [dt.date(2023, 1, 1)], dt.date(2023, 1, 1))],
                                 "user_id bigint, dates_active array<date>, snapshot_date date")
    # columns by name, in any order
    catalog.append(day1.select("snapshot_date", "dates_active", "user_id"), t)
    catalog.overwrite_partitions(day1, t)  # rerun of the same day: replaced, not duplicated
    day2 = day1.withColumn("snapshot_date", F.lit(dt.date(2023, 1, 2)))
    catalog.overwrite_partitions(day2, t)
    tab = spark.table(t)
    assert tab.count() == 2
    quality.assert_unique(tab, catalog.TABLES["users_cumulated"]["key"])
    b = catalog.create_reference_table(spark, "array_metrics", f"{db}.am", bucket_by=["user_id"], n_buckets=4)
    desc = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {b}").collect()}
    assert desc.get("Num Buckets") == "4"
    catalog.drop_table(spark, b)
    assert not spark.catalog.tableExists(b)


def test_year_partition_column(spark):
    ev = read_table(spark, SF_SMALL, "events").withColumn("event_date", F.to_date("ts"))
    out = catalog.with_year(ev, "event_date")
    assert out.select("event_date_year").distinct().collect()[0][0] == 2024


def test_primary_key_check_refuses_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        quality.assert_unique(df, ["k"])


def test_run_table_job_scd(spark):
    from cumulo.operators import history
    db = f"cumulo_jobs_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, db, location=work_path(spark, db))
    src = spark.createDataFrame(
        [("Ada Quill", 1991, "high"), ("Ada Quill", 1992, "high"), ("Ada Quill", 1994, "low")],
        "player_name string, current_season bigint, scoring_class string")
    src.write.saveAsTable(f"{db}.players")
    target = catalog.create_reference_table(spark, "players_scd", f"{db}.players_scd")
    job = lambda df: history.scd2(df, "player_name", "current_season", "scoring_class")
    catalog.run_table_job(spark, f"{db}.players", job, target)
    catalog.run_table_job(spark, f"{db}.players", job, target)  # rerun: replaced, not appended
    got = sorted(tuple(r) for r in spark.table(target).collect())
    assert got == [("Ada Quill", "high", 1991, 1992), ("Ada Quill", "low", 1994, 1994)]


def test_run_table_job_partitioned_target_replaces_only_its_days(spark):
    from cumulo.operators import cumulative
    db = f"cumulo_jobs_p_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, db, location=work_path(spark, db))
    ev = read_table(spark, SF_SMALL, "events").select("user_id", "ts")
    ev.write.saveAsTable(f"{db}.events")
    target = catalog.create_reference_table(spark, "users_cumulated", f"{db}.users_cumulated")
    for day in (dt.date(2024, 1, 10), dt.date(2024, 1, 11), dt.date(2024, 1, 11)):  # last one is a rerun
        catalog.run_table_job(spark, f"{db}.events",
                              lambda df, d=day: cumulative.rebuild_dates(df, "user_id", "ts", d), target)
    per_day = {r["snapshot_date"]: r["count"] for r in spark.table(target).groupBy("snapshot_date").count().collect()}
    want = cumulative.rebuild_dates(ev, "user_id", "ts", dt.date(2024, 1, 11)).count()
    assert set(per_day) == {dt.date(2024, 1, 10), dt.date(2024, 1, 11)}
    assert per_day[dt.date(2024, 1, 11)] == want


def test_run_table_job_clears_its_partition_when_empty(spark):
    from cumulo.operators import cumulative
    db = f"cumulo_jobs_e_{uuid.uuid4().hex[:8]}"
    catalog.ensure_database(spark, db, location=work_path(spark, db))
    read_table(spark, SF_SMALL, "events").select("user_id", "ts").write.saveAsTable(f"{db}.events")
    target = catalog.create_reference_table(spark, "users_cumulated", f"{db}.users_cumulated")
    day, other = dt.date(2024, 1, 10), dt.date(2024, 1, 9)
    for d in (other, day):
        catalog.run_table_job(spark, f"{db}.events", lambda df, d=d: cumulative.rebuild_dates(df, "user_id", "ts", d),
                              target, partition={"snapshot_date": d})
    before = spark.table(target).where(F.col("snapshot_date") == F.lit(other)).count()
    catalog.run_table_job(spark, f"{db}.events",
                          lambda df: cumulative.rebuild_dates(df.where("false"), "user_id", "ts", day),
                          target, partition={"snapshot_date": day})
    assert spark.table(target).where(F.col("snapshot_date") == F.lit(day)).count() == 0
    assert spark.table(target).where(F.col("snapshot_date") == F.lit(other)).count() == before > 0


def test_checkpoint_root_refuses_a_local_folder_on_a_cluster():
    from cumulo.sources.session import checkpoint_root

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)


def test_a_partition_column_declared_in_the_clause_only(spark):
    import datetime as dt
    import uuid
    from cumulo.sources import catalog
    name = f"clause_{uuid.uuid4().hex[:8]}"
    catalog.create_table(spark, name, "k int, v string", partition_by=["day date"], location=work_path(spark, name))
    assert spark.table(name).columns == ["k", "v", "day"]
    rows_ = [(1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2024, 1, 2)), (3, "c", None)]
    df = spark.createDataFrame(rows_, "k int, v string, day date")
    catalog.append(df.select("day", "v", "k"), name)  # by name, in any order
    catalog.overwrite_partitions(df.where("k = 2").withColumn("v", F.lit("z")), name)
    got = sorted((tuple(r) for r in spark.table(name).collect()), key=repr)
    assert got == sorted([rows_[0], (2, "z", dt.date(2024, 1, 2)), rows_[2]], key=repr)
    plan = spark.table(name).where("day = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    catalog.drop_table(spark, name)
