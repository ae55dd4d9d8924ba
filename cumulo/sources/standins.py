"""Stand-in inputs: the driver's test tables reshaped into the schemas the
jobs expect (renames, casts and simple derived columns only).

None of these does a job's work; each job runs unchanged on any data of
the same schema.  The mapping follows SURVEY §7.4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fact_details(lineitem: DataFrame) -> DataFrame:
    """Line items with a ``min_text`` column in ``mm:ss`` text form, the
    kind of loosely typed column a fact load has to parse."""
    return lineitem.withColumn(
        "min_text",
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(":"),
                 (F.col("l_linenumber") * 7).cast("string")))


def activity_events(events: DataFrame) -> DataFrame:
    """Events as user activity: ``user_id``, ``event_time``, ``host``
    (the event type) and ``device_id`` (the ``k`` of ``props``)."""
    return events.select(
        F.col("user_id"),
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("host"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("device_id"))


def sparse_hosts(events: DataFrame) -> DataFrame:
    """Events keyed by a sparser host: ``event_type/k`` (about 500 values)."""
    return events.select(
        F.concat(F.col("event_type"), F.lit("/"), F.get_json_object("props", "$.k")).alias("host"),
        F.col("user_id"),
        F.col("ts").alias("event_time"))


def player_seasons(orders: DataFrame) -> DataFrame:
    """(entity, season, class) rows: customers per order year, classed by
    how many orders they placed that year."""
    per_year = (orders.groupBy(F.col("o_custkey").alias("player_name"),
                               F.year("o_orderdate").alias("current_season"))
                      .agg(F.count(F.lit(1)).alias("n")))
    return per_year.select(
        "player_name", "current_season",
        F.when(F.col("n") >= 3, "star").when(F.col("n") == 2, "good").otherwise("average")
         .alias("scoring_class"))


def teams(lineitem: DataFrame) -> DataFrame:
    """Vertex rows with many duplicates per id: one row per line item,
    keyed by supplier."""
    return lineitem.select(
        F.col("l_suppkey").alias("team_id"),
        F.col("l_returnflag").alias("abbreviation"),
        F.col("l_linestatus").alias("nickname"),
        F.col("l_partkey").cast("string").alias("city"),
        F.col("l_orderkey").cast("string").alias("arena"),
        F.year("l_shipdate").alias("yearfounded"))


def matches(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Matches: one per order; playlist = priority, map = customer's nation."""
    return (orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
                  .select(F.col("o_orderkey").alias("match_id"),
                          F.col("c_nationkey").cast("bigint").alias("mapid"),
                          F.col("o_orderpriority").alias("playlist_id"),
                          (F.col("o_orderstatus") == "F").alias("is_team_game"),
                          F.col("o_orderdate").alias("completion_date")))


def maps(nation: DataFrame, region: DataFrame) -> DataFrame:
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "inner")
                  .select(F.col("n_nationkey").cast("bigint").alias("mapid"),
                          F.col("n_name").alias("name"),
                          F.col("r_name").alias("description")))


def match_details(lineitem: DataFrame) -> DataFrame:
    """A player's line in a match: player = supplier, kills = quantity."""
    return lineitem.select(F.col("l_orderkey").alias("match_id"),
                           F.col("l_suppkey").alias("player_gamertag"),
                           F.col("l_quantity").cast("int").alias("player_total_kills"),
                           F.col("l_linenumber").alias("player_total_deaths"))


def medals_matches_players(lineitem: DataFrame) -> DataFrame:
    """Medals won: medal = part, count = line number."""
    return lineitem.select(F.col("l_orderkey").alias("match_id"),
                           F.col("l_suppkey").alias("player_gamertag"),
                           F.col("l_partkey").alias("medal_id"),
                           F.col("l_linenumber").alias("count"))


def medals(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("medal_id"),
                       F.col("p_type").alias("name"),
                       F.col("p_brand").alias("classification"))
