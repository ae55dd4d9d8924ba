"""The three scenarios the reference tests, order-insensitive."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulo.operators import graph, history, metrics
from tests.conftest import rows


def test_monthly_hits(spark):
    ds = "2023-03-01"
    df = spark.createDataFrame(
        [(ds, [4, 0, 2], ds), (ds, [5, 7, 1], ds), ("2023-04-01", [], ds), ("2023-04-01", [], "")],
        "month_start string, hit_array array<bigint>, date_partition string")
    out = metrics.monthly_hits(df, ds)
    assert out.columns == ["month_start", "num_hits_first_day", "num_hits_second_day", "num_hits_third_day"]
    assert rows(out) == [("2023-03-01", 9, 7, 3), ("2023-04-01", 0, 0, 0)]


@pytest.mark.parametrize("n_chunks", [1, 2, 3, 8])
def test_player_scd(spark, n_chunks):
    df = spark.createDataFrame(
        [("Ada Quill", 1991, "high"), ("Ada Quill", 1992, "high"),
         ("Ada Quill", 1994, "low"), ("Bo Tarn", 1994, "low")],
        "player_name string, current_season bigint, scoring_class string")
    out = history.scd2(df, "player_name", "current_season", "scoring_class", chunk_width=n_chunks)
    assert out.columns == ["player_name", "scoring_class", "start_date", "end_date"]
    assert rows(out) == sorted([("Ada Quill", "high", 1991, 1992), ("Ada Quill", "low", 1994, 1994),
                                ("Bo Tarn", "low", 1994, 1994)], key=repr)


def test_team_vertex(spark):
    df = spark.createDataFrame(
        [(1, "LKT", "Lake Kites", "Port Elm", "Elm Hall", 1955),
         (1, "LKT", "Blue Kites", "Port Elm", "Elm Hall", 1955)],
        "team_id bigint, abbreviation string, nickname string, city string, arena string, yearfounded bigint")
    out = graph.team_vertices(df, order_by=[F.col("nickname").desc()])
    got = out.collect()
    assert len(got) == 1
    assert got[0]["identifier"] == 1 and got[0]["type"] == "team"
    assert got[0]["properties"] == {"abbreviation": "LKT", "nickname": "Lake Kites", "city": "Port Elm",
                                    "arena": "Elm Hall", "year_founded": "1955"}
    assert out.schema["properties"].dataType.simpleString() == "map<string,string>"


def test_team_vertex_default_order_is_deterministic(spark):
    df = spark.createDataFrame(
        [(1, "LKT", "Lake Kites", "PE", "EH", 1955), (1, "LKT", "Blue Kites", "PE", "EH", 1955)],
        "team_id bigint, abbreviation string, nickname string, city string, arena string, yearfounded bigint")
    # default order: all columns ascending -> "Blue Kites" < "Lake Kites"
    got = graph.team_vertices(df).collect()
    assert got[0]["properties"]["nickname"] == "Blue Kites"


def test_dates_are_dates(spark):
    # month arithmetic stays in DateType (date + n days is a date)
    d = spark.range(1).select(F.date_add(F.to_date(F.lit("2023-01-31")), 1).alias("d")).collect()[0]["d"]
    assert d == dt.date(2023, 2, 1)
