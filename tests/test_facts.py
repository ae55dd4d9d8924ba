"""Fact load (J1-J4) on edge fixtures."""

import pytest
from pyspark.sql import functions as F

from cumulo.functions.text import minutes_from_text, token_flag
from cumulo.operators import facts, quality
from cumulo.plans.inspect import physical_plan
from tests.conftest import rows

DETAIL_SCHEMA = ("game_id bigint, team_id bigint, player_id bigint, player_name string, "
                 "start_position string, comment string, min string, "
                 + ", ".join(f"`{c}` int" for c in facts.GAME_MEASURES.values()))


def detail(game, team, player, comment=None, mins="10:00", pts=0, name="p"):
    measures = [0] * len(facts.GAME_MEASURES)
    measures[list(facts.GAME_MEASURES.values()).index("pts")] = pts
    return (game, team, player, name, "F", comment, mins, *measures)


@pytest.fixture()
def game_inputs(spark):
    details = spark.createDataFrame([
        detail(1, 10, 100, None, "12:30", pts=5),
        detail(1, 10, 100, None, "12:30", pts=9),      # duplicate key, other values
        detail(1, 10, 101, "DNP - Coach", None),
        detail(1, 20, 102, "NWT - injury", "12"),
        detail(2, None, 103, "DND - sick", ""),        # NULL team id
        detail(2, 20, 104, None, "ab:10"),
    ], DETAIL_SCHEMA)
    games = spark.createDataFrame(
        [(1, "2023-01-01", 2022, 10), (2, "2023-01-02", 2022, 20)],
        "game_id bigint, game_date_est string, season int, home_team_id bigint")
    return details, games


def test_game_fact(spark, game_inputs):
    details, games = game_inputs
    out = facts.game_fact(details, games, order_by=[F.col("pts").desc()])
    got = {r["dim_player_id"]: r for r in out.collect()}
    assert len(got) == 5
    assert got[100]["m_pts"] == 9  # explicit order picks the survivor
    assert got[100]["m_minutes"] == pytest.approx(12.5)
    assert got[100]["dim_is_playing_at_home"] is True
    assert got[101]["dim_not_play"] is True and got[101]["m_minutes"] is None
    assert got[102]["dim_not_with_team"] is True and got[102]["m_minutes"] == 12.0
    assert got[102]["dim_is_playing_at_home"] is False
    assert got[103]["dim_not_dress"] is True and got[103]["m_minutes"] is None
    assert got[103]["dim_is_playing_at_home"] is None  # NULL team id stays NULL
    assert got[104]["m_minutes"] is None  # bad minutes part
    assert got[100]["dim_not_play"] is False  # NULL comment -> False
    assert str(got[100]["dim_game_date"]) == "2023-01-01"


def test_game_fact_dedups_before_join(spark, game_inputs):
    details, games = game_inputs
    plan = physical_plan(facts.game_fact(details, games))
    # partial per-task group limit below the shuffle
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_duplicate_report(spark, game_inputs):
    details, _ = game_inputs
    out = quality.duplicate_report(details, ["game_id", "team_id", "player_id"])
    assert rows(out) == [(1, 10, 100, 2)]


def test_assert_unique(spark, game_inputs):
    details, _ = game_inputs
    quality.assert_unique(details, ["game_id", "player_id", "pts"])
    with pytest.raises(ValueError):
        quality.assert_unique(details, ["game_id", "team_id", "player_id"])


def test_token_and_minutes(spark):
    df = spark.createDataFrame([(None, None), ("DNP - x", "12"), ("x", "12:30"), ("NWT", ""), ("", "7:xx")],
                               "comment string, min string")
    out = df.select(token_flag("comment", "DNP").alias("f"), minutes_from_text("min").alias("m")).collect()
    assert [r["f"] for r in out] == [False, True, False, False, False]
    assert [r["m"] for r in out] == [None, 12.0, 12.5, None, None]


def test_conditional_rate(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", False), ("c", True), ("c", None)],
                               "k string, flag boolean")
    out = facts.conditional_rate(df, "k", "flag")
    assert [tuple(r) for r in out.collect()] == [("a", 2, 1, 0.5), ("c", 2, 1, 0.5), ("b", 1, 0, 0.0)]


def test_enrich_broadcasts_small_dim(spark):
    fact = spark.range(1000).withColumn("team", F.col("id") % 3)
    dim = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "team_id long, name string")
    out = facts.enrich(fact, dim, "team", "team_id")
    assert "BroadcastHashJoin" in physical_plan(out)
    assert out.count() == 1000


def test_cardinality_and_time_range(spark):
    df = spark.createDataFrame([("a", "2024-01-01 10:00:00"), ("b", "2024-01-03 11:00:00"), ("a", None)],
                               "host string, ts string").withColumn("ts", F.to_timestamp("ts"))
    c = quality.cardinality(df.withColumn("d", F.to_date("ts")), ["host", "d"]).collect()[0]
    assert (c["n_host"], c["n_d"]) == (2, 2)
    t = quality.time_range(df, "ts").collect()[0]
    assert str(t["first_ts"]).startswith("2024-01-01") and str(t["last_ts"]).startswith("2024-01-03")
