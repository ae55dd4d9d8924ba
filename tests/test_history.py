"""SCD2 (J12): fixtures for §8-Q9 and a property test against brute force."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cumulo.operators import history
from tests.conftest import rows

SCHEMA = "e string, o int, v string"


def brute(data, null_safe=True):
    """Plain Python gaps-and-islands (the reference semantics when not null-safe)."""
    out = []
    by_e = {}
    for e, o, v in data:
        by_e.setdefault(e, []).append((o, v))
    for e, seq in by_e.items():
        seq.sort()
        streak = 0
        groups = {}
        prev = None
        for i, (o, v) in enumerate(seq):
            if null_safe:
                changed = i == 0 or prev != v
            else:
                changed = i == 0 or prev is None or (v is not None and prev != v)
            if changed:
                streak += 1
            key = (streak,) if null_safe else (streak, v)
            g = groups.setdefault(key, [v, o, o])
            g[1], g[2] = min(g[1], o), max(g[2], o)
            prev = v
        out += [(e, v, s, t) for v, s, t in groups.values()]
    return sorted(out, key=repr)


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("n_chunks", [1, 3, 7])
def test_null_cases(spark, null_safe, n_chunks):
    data = [("x", 1, None), ("x", 2, None), ("x", 3, "A"), ("x", 4, None), ("x", 5, "A"), ("x", 6, "A"),
            ("y", 1, "A"), ("y", 2, "B"), ("y", 5, "A"),  # A -> B -> A with a gap in seasons
            (None, 1, "Q"), (None, 2, "Q")]
    df = spark.createDataFrame(data, SCHEMA)
    got = rows(history.scd2(df, "e", "o", "v", null_safe=null_safe, chunk_width=n_chunks))
    assert got == brute(data, null_safe)
    assert rows(history.scd2_windowed(df, "e", "o", "v", null_safe=null_safe)) == got


def test_reference_null_behaviour(spark):
    df = spark.createDataFrame([("x", 1, None), ("x", 2, None), ("x", 3, "A"), ("x", 4, None)], SCHEMA)
    assert len(history.scd2(df, "e", "o", "v", null_safe=False).collect()) == 4
    safe = rows(history.scd2(df, "e", "o", "v"))
    assert safe == sorted([("x", None, 1, 2), ("x", "A", 3, 3), ("x", None, 4, 4)], key=repr)


entity = st.sampled_from(["a", "b", "c"])
value = st.one_of(st.none(), st.sampled_from(["G", "B"]))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(entity, st.integers(0, 60), value), min_size=1, max_size=40,
                unique_by=lambda t: (t[0], t[1])),
       st.integers(1, 6), st.booleans())
def test_chunked_equals_brute_force(spark, data, n_chunks, null_safe):
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(history.scd2(df, "e", "o", "v", null_safe=null_safe, chunk_width=n_chunks)) == brute(data, null_safe)


def test_hot_entity_is_split_across_chunks(spark):
    """One entity with all rows still spreads over several tasks."""
    df = spark.range(0, 4000).select(F.lit("hot").alias("e"), F.col("id").cast("int").alias("o"),
                                     (F.floor(F.col("id") / 100) % 2).cast("string").alias("v"))
    out = history.scd2(df, "e", "o", "v", chunk_width=500)
    assert out.count() == 40
    chunks = df.select(history.order_chunk(df, "o", 500).alias("c")).distinct().count()
    assert chunks == 8


def test_one_exchange_of_all_rows_and_no_sampling(spark):
    import re
    from cumulo.plans.inspect import physical_plan
    df = spark.range(0, 400).select((F.col("id") % 4).alias("e"), F.col("id").cast("int").alias("o"),
                                    (F.floor(F.col("id") / 100) % 2).cast("string").alias("v"))
    plan = physical_plan(history.scd2(df, "e", "o", "v"))
    assert "rangepartitioning" not in plan
    # the chunked rows are exchanged once: other branches reuse that exchange
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning\(e#\d+L?, _chunk#\d+L", plan)) >= 1


def test_dates_are_chunked_by_month(spark):
    import datetime as dt
    data = [("x", dt.date(2023, 1, 30) + dt.timedelta(days=i), "A" if i < 40 else "B") for i in range(80)]
    df = spark.createDataFrame(data, "e string, o date, v string")
    got = rows(history.scd2(df, "e", "o", "v"))
    assert got == sorted([("x", "A", dt.date(2023, 1, 30), dt.date(2023, 3, 10)), ("x", "B", dt.date(2023, 3, 11), dt.date(2023, 4, 19))], key=repr)


def test_intervals_cover_rows_without_overlap(spark):
    from cumulo.sources.tables import read_table
    from cumulo.sources import standins
    from tests.conftest import SF_SMALL
    players = standins.player_seasons(read_table(spark, SF_SMALL, "orders"))
    out = history.scd2(players, "player_name", "current_season", "scoring_class", chunk_width=2).collect()
    by_e = {}
    for r in out:
        by_e.setdefault(r["player_name"], []).append((r["start_date"], r["end_date"], r["scoring_class"]))
    seasons = {}
    for r in players.collect():
        seasons.setdefault(r["player_name"], []).append((r["current_season"], r["scoring_class"]))
    assert set(by_e) == set(seasons)
    for e, ivs in by_e.items():
        ivs.sort()
        for (s1, t1, _), (s2, _, _) in zip(ivs, ivs[1:]):
            assert t1 < s2  # no overlap
        for season, cls in seasons[e]:  # every row inside exactly one interval of its class
            hits = [c for s, t, c in ivs if s <= season <= t]
            assert hits == [cls]


def test_sizing_conf():
    from cumulo.sources.session import sizing_conf
    c = sizing_conf(100 * 1024 ** 4)  # 100 TiB
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(sizing_conf(1024)["spark.sql.shuffle.partitions"]) == 4000  # one wave minimum


def test_duplicate_entity_order_is_refused(spark):
    import pytest as _pytest
    from cumulo.operators import quality
    df = spark.createDataFrame([("x", 2001, "A"), ("x", 2001, "B"), ("x", 2002, "A")], SCHEMA)
    with _pytest.raises(ValueError, match="duplicate"):
        quality.assert_unique(df, ["e", "o"])


@pytest.mark.parametrize("kind", ["timestamp", "seconds", "double", "string"])
def test_a_hot_entity_within_one_month_is_split(spark, kind):
    """Cuts follow the rows, whatever the order column's scale."""
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60)
    order = {"timestamp": ts, "seconds": F.unix_seconds(ts), "double": F.col("id") / 7.0, "string": F.lpad(F.col("id").cast("string"), 8, "0")}[kind]
    hot = spark.range(0, 3000).select(F.lit("hot").alias("e"), order.alias("o"), (F.floor(F.col("id") / 100) % 2).cast("string").alias("v"))
    far = spark.range(0, 3000).select(F.concat(F.lit("e"), F.col("id") % 300).alias("e"), F.col("id"), F.lit("x").alias("v"))
    other = far.select("e", {"timestamp": F.timestamp_seconds(F.col("id") * 500_000), "seconds": F.col("id") * 500_000,
                             "double": F.col("id") * 1000.0, "string": F.lpad(F.col("id").cast("string"), 8, "9")}[kind].alias("o"), "v")
    df = hot.unionByName(other)
    out = history.scd2(df, "e", "o", "v", chunk_rows=100)
    assert rows(out) == rows(history.scd2_windowed(df, "e", "o", "v")) and out.where("e = 'hot'").count() == 30
    cuts = history.order_cuts(df, "o", 100)
    sizes = [r["count"] for r in hot.groupBy(history.order_chunk(hot, "o", cuts=cuts).alias("c")).count().collect()]
    if kind != "string":  # texts have no cuts
        assert len(sizes) >= 25 and max(sizes) <= 300


def test_many_cuts_are_looked_up_in_two_steps(spark):
    df = spark.range(0, 5000).select(F.col("id").cast("double").alias("o"))
    cuts = [float(x) for x in range(3, 4999, 7)]
    got = df.select("o", history.order_chunk(df, "o", cuts=cuts).alias("c")).collect()
    assert all(r["c"] == sum(x <= r["o"] for x in cuts) for r in got)


def test_at_most_five_exchanges(spark):
    from cumulo.plans.inspect import exchanges
    df = spark.range(0, 400).select((F.col("id") % 4).alias("e"), F.col("id").cast("int").alias("o"),
                                    (F.floor(F.col("id") / 100) % 2).cast("string").alias("v"))
    assert exchanges(history.scd2(df, "e", "o", "v")) <= 5
