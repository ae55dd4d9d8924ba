"""Catalog tables: the reference's table layouts as Spark DDL, and the
write modes its loads use.

Spark does not enforce primary keys; the key of each table is kept next
to its schema and checked with ``quality.assert_unique`` where a load must
not duplicate it.  Iceberg partition transforms (``years(d)``) are not
available on parquet tables, so a year column is materialised instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cumulo.functions.util import names
from cumulo.plans.inspect import session_conf

# The reference's table layouts (columns, primary key,
# partition columns).  Types follow SURVEY §1.2 (real -> double).
TABLES = {
    "fact_game_details": {
        "columns": (
            "game_id int, dim_game_date date, dim_season int, dim_team_id int, dim_player_id int, "
            "dim_player_name string, dim_start_position string, dim_is_playing_at_home boolean, "
            "dim_not_play boolean, dim_not_dress boolean, dim_not_with_team boolean, m_minutes double, "
            "m_fgm int, m_fga int, m_fg3m int, m_fg3a int, m_ftm int, m_fta int, m_oreb int, m_dreb int, "
            "m_reb int, m_ast int, m_stl int, m_blk int, m_turnovers int, m_pf int, m_pts int, "
            "m_plus_minus int"),
        "key": ["dim_game_date", "dim_player_id", "dim_team_id"],
        "partition_by": [],
    },
    "users_cumulated": {
        "columns": "user_id bigint, dates_active array<date>, snapshot_date date",
        "key": ["user_id", "snapshot_date"],
        "partition_by": ["snapshot_date"],
    },
    "hosts_cumulated": {
        "columns": "host string, dates_active array<date>, snapshot_date date",
        "key": ["host", "snapshot_date"],
        "partition_by": ["snapshot_date"],
    },
    "array_metrics": {
        "columns": "user_id bigint, month_start date, metric_array array<double>, date_partition date, "
                   "metric_name string",
        "key": ["user_id", "month_start", "metric_name", "date_partition"],
        "partition_by": ["date_partition", "metric_name"],
    },
    "user_devices_cumulated": {
        "columns": "user_id bigint, device_activity_datelist map<string,array<date>>, snapshot_date date",
        "key": ["user_id", "snapshot_date"],
        "partition_by": ["snapshot_date"],
    },
    "host_activity_reduced": {
        "columns": "host string, month_start date, hit_array array<bigint>, unique_visitors array<bigint>, "
                   "date_partition date",
        "key": ["host", "month_start", "date_partition"],
        "partition_by": ["date_partition"],
    },
    "events_aggregated_staging": {
        "columns": "user_id bigint, device_id bigint, event_counts bigint, host_array array<string>, ds string",
        "key": ["user_id", "device_id", "ds"],
        "partition_by": ["ds"],
    },
    "stg_maps_medals": {
        "columns": "mapid string, name string, description string, match_id string, is_team_game boolean, "
                   "playlist_id string, completion_date timestamp, player_gamertag string, medal_id bigint, "
                   "count int",
        "key": ["match_id", "player_gamertag", "medal_id"],
        "partition_by": [],
    },
    "players_scd": {
        "columns": "player_name string, scoring_class string, start_date bigint, end_date bigint",
        "key": ["player_name", "start_date"],
        "partition_by": [],
    },
    "vertices": {
        "columns": "identifier bigint, type string, properties map<string,string>",
        "key": ["identifier", "type"],
        "partition_by": [],
    },
}


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table(spark: SparkSession, name: str, columns: str, partition_by=(), bucket_by=(),
                 n_buckets: int | None = None, location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` with optional
    partition columns, buckets and location.  Partition columns may be
    listed in ``columns`` (they are moved to the end, as Spark stores them)."""
    parts = names(partition_by) if partition_by else []
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if parts:
        ddl += f" PARTITIONED BY ({', '.join(parts)})"
    if bucket_by:
        if not n_buckets:
            raise ValueError("give n_buckets for the table's size (streaming.daily.buckets_for)")
        ddl += f" CLUSTERED BY ({', '.join(names(bucket_by))}) INTO {n_buckets} BUCKETS"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)
    return name


def create_reference_table(spark: SparkSession, kind: str, name: str | None = None,
                           location: str | None = None, bucket_by=(), n_buckets: int | None = None) -> str:
    """Create one of the reference's tables (see ``TABLES``)."""
    spec = TABLES[kind]
    return create_table(spark, name or kind, spec["columns"], spec["partition_by"], bucket_by,
                        n_buckets, location)


def append(df: DataFrame, table: str) -> None:
    """``INSERT INTO`` by name: columns are matched to the table by name,
    not by position."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.mode("append").insertInto(table)


def overwrite_partitions(df: DataFrame, table: str, partition: dict | None = None) -> None:
    """Replace the partitions present in ``df`` (rerun-safe load).

    With ``partition`` (partition column -> value) that one partition is what
    the load is for: a result without rows clears it, too.
    """
    spark = df.sparkSession
    cols = spark.table(table).columns
    seen = Observation()
    # insertInto ignores the writer option; the session setting decides
    with session_conf(spark, **{"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        df.select(*cols).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").insertInto(table)
    if partition and not seen.get["n"]:
        rest = spark.createDataFrame([], spark.table(table).drop(*partition).schema)
        view = f"{table.replace('.', '_')}_none"
        rest.createOrReplaceTempView(view)
        spec = ", ".join(f"{c} = '{v}'" for c, v in partition.items())
        try:
            with session_conf(spark, **{"spark.sql.sources.partitionOverwriteMode": "static"}):
                spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT * FROM {view}")
        finally:
            spark.catalog.dropTempView(view)


def with_year(df: DataFrame, date_col: str, year_col: str | None = None) -> DataFrame:
    """Materialise ``year(date_col)`` so a parquet table can be partitioned
    by year (the role of Iceberg's ``years()`` transform)."""
    return df.withColumn(year_col or f"{date_col}_year", F.year(date_col))


def run_table_job(spark: SparkSession, source: str, transform, target: str,
                  overwrite: bool = True, partition: dict | None = None) -> None:
    """Table in, table out: ``spark.table(source)`` -> ``transform`` ->
    ``target`` (columns matched by name; overwrite replaces the table's
    data, or only the written partitions when the table is partitioned;
    ``partition`` as in ``overwrite_partitions``)."""
    partitioned = bool(_partition_columns(spark, target))
    if overwrite and not partitioned and _location(spark, source) == _location(spark, target):
        raise ValueError(f"{target} is read by the job; write to another table (or a partitioned "
                         "target, where only the written partitions are replaced)")
    out = transform(spark.table(source))
    if not overwrite:
        append(out, target)
    elif partitioned:
        overwrite_partitions(out, target, partition)
    else:
        cols = spark.table(target).columns
        out.select(*cols).write.mode("overwrite").insertInto(target)


def _location(spark: SparkSession, table: str) -> str:
    """Where a table's data is (its name for a view), from the catalog alone."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type").take(1)
    return rows[0][0].rstrip("/") if rows else table


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
