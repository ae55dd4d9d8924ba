"""Footers, space-filling orders, run-time filters, summary-based top-k."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cumulo.operators import heavy, joins, quality
from cumulo.plans import curves, layout
from cumulo.plans.inspect import physical_plan
from cumulo.sources import footers
from cumulo.sources.session import work_path
from cumulo.sources.tables import read_table
from tests.conftest import SF_SMALL, rows


def written(spark, name, files=3):
    df = spark.range(0, 1000).select(
        F.col("id"), (F.col("id") % 7).cast("int").alias("k"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), F.col("id"))).alias("s"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("d"), (F.col("id") / 4).alias("x"))
    path = work_path(spark, name)
    df.repartitionByRange(files, "id").write.parquet(path)
    return df, path


@pytest.mark.parametrize("per_task", [1, 64])
def test_footers_tell_rows_bounds_and_nulls(spark, per_task):
    df, path = written(spark, "footers")
    found = footers.footers(spark, path, per_task)
    assert found.rdd.getNumPartitions() == (3 if per_task == 1 else 1)
    files = footers.file_report(found).first()
    listed = layout.file_listing(spark, path).agg(F.sum("length"), F.count("*")).first()
    assert (files["size"], files["num_files"], files["num_rows"]) == (listed[0], listed[1], 1000)
    got = {r["column"]: (r["num_rows"], r["nulls"], r["least"], r["greatest"]) for r in footers.column_report(found, df.schema).collect()}
    text = lambda c: tuple(df.agg(F.min(c).cast("string"), F.max(c).cast("string")).first())
    assert got == {c: (1000, 200 if c == "s" else 0, *text(c)) for c in df.columns}
    assert all(r["compressed"] > 0 and r["encodings"] for r in footers.column_report(found, df.schema).collect())


def test_footers_of_empty_and_missing_rows(spark):
    path = work_path(spark, "no_rows")
    spark.range(0).write.parquet(path)
    report = footers.file_report(footers.footers(spark, path)).first()
    assert report["num_rows"] == 0 and report["num_files"] >= 1


def test_bounds_come_from_footers(spark):
    df, path = written(spark, "bounds")
    got = quality.footer_bounds(spark, path, ["id", "k", "d", "x"])
    plan = physical_plan(got)
    assert "PushedAggregation: [COUNT(*), MIN(id)" in plan and "ReadSchema: struct<count(*)" in plan
    want = df.agg(F.count("*"), *[f(c) for c in ("id", "k", "d", "x") for f in (F.min, F.max)])
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    with pytest.raises(ValueError):
        quality.footer_bounds(spark, path, ["s"])
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


# --- orders of files ------------------------------------------------------------

def test_unsorted_rows_across_batches_and_files(spark):
    rng = random.Random(2)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"])) for _ in range(500)]
    path = work_path(spark, "unsorted")
    spark.createDataFrame(data, "k int, s string").coalesce(2).write.parquet(path)
    want = 0
    got = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).collect()
    by_file = {}
    for r in sorted(got, key=lambda r: (r["f"], r["i"])):
        by_file.setdefault(r["f"], []).append(((r["k"] is not None, r["k"] or 0), (r["s"] is not None, r["s"] or "")))
    want = sum(a > b for rs in by_file.values() for a, b in zip(rs, rs[1:]))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        assert layout.unsorted_rows(spark, path, ["k", "s"]).first()[0] == want > 50
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a bigint, b bigint")
    got = {(r["a"], r["b"]): r["z"] for r in df.withColumn("z", curves.interleave([F.col("a"), F.col("b")], 3)).collect()}
    want = {(a, b): sum(((a >> i & 1) << (2 * i + 1)) | ((b >> i & 1) << (2 * i)) for i in range(3)) for a in range(8) for b in range(8)}
    assert got == want and len(set(got.values())) == 64


def test_range_ranks_keep_order_and_spread(spark):
    rng = random.Random(3)
    data = [(rng.gauss(0, 5), dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(300)), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(10**6)),
             rng.choice(["", "a", "abc", "b", "é", "zz"]), None) for _ in range(2000)]
    df = spark.createDataFrame(data, "x double, d date, t timestamp, s string, n int")
    for c in ("x", "d", "t", "s"):
        cuts = curves.range_cuts(df, c, 4)[c]
        got = sorted((r[c], r["r"]) for r in df.select(c, curves.range_rank(df, c, cuts).alias("r")).collect())
        assert [r for _, r in got] == sorted(r for _, r in got)
        if c != "s":
            assert max(Counter(r for _, r in got).values()) < 2 * 2000 / 16
    assert df.select(curves.range_rank(df, "n", curves.range_cuts(df, "n", 4)["n"])).distinct().collect()[0][0] == 0


def test_curve_skips_row_groups_in_both_columns(spark):
    df = spark.range(0, 40_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("b"))
    found = layout.compare_layouts(df, {"a_b": ["a", "b"], "b_a": ["b", "a"]}, curves={"z": ["a", "b"]},
                                   filters={"a": (100, 110), "b": (100, 110)})
    assert {r["num_rows"] for r in found.collect()} == {40_000}
    base = work_path(spark, "skipping")
    paths = {}
    for name, keys in (("a_b", ["a", "b"]), ("z", None)):
        paths[name] = f"{base}/{name}"
        if keys:
            df.repartitionByRange(64, *keys).sortWithinPartitions(*keys).write.parquet(paths[name])
        else:
            curves.write_curve(df, paths[name], ["a", "b"], n=64)
        assert rows(spark.read.parquet(paths[name])) == rows(df)
    skipped = {(n, c): footers.skipped_groups(footers.footers(spark, p), c, "bigint", 100, 110).first() for n, p in paths.items() for c in "ab"}
    share = {k: r["skipped"] / r["row_groups"] for k, r in skipped.items()}
    assert share["a_b", "b"] < 0.1 and share["z", "a"] > 0.6 and share["z", "b"] > 0.6
    assert min(share["z", "a"], share["z", "b"]) > min(share["a_b", "a"], share["a_b", "b"])
    # what is skipped holds no such row
    for n, p in paths.items():
        assert spark.read.parquet(p).where("b between 100 and 110").count() == df.where("b between 100 and 110").count()


# --- run-time filter --------------------------------------------------------------

def test_bloom_filter_drops_rows_before_the_shuffle(spark):
    big = read_table(spark, SF_SMALL, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    few = read_table(spark, SF_SMALL, "orders").where("o_totalprice > 400000").select("o_orderkey", "o_custkey")
    out = joins.join_small(big, few, "o_orderkey", strategy="bloom")
    plan = physical_plan(out)
    assert "might_contain" in plan and "SortMergeJoin" in plan
    assert rows(out) == rows(big.join(few, "o_orderkey"))

    def shuffled(df):
        df.collect()
        found = []

        def walk(node):
            if "ShuffleExchange" in node.getClass().getSimpleName():
                found.append(node.metrics().get("shuffleRecordsWritten").get().value())
            if "QueryStage" in node.getClass().getSimpleName():
                walk(node.plan())
            for i in range(node.children().size()):
                walk(node.children().apply(i))
        walk(df._jdf.queryExecution().executedPlan().executedPlan())
        return max(found)

    plain = joins.join_small(big, few, "o_orderkey", strategy="shuffle")
    with_filter, without = shuffled(out), shuffled(plain)
    assert without == big.count() and with_filter < without / 3
    assert "might_contain" not in physical_plan(plain)
    with pytest.raises(ValueError):
        joins.bloom_join(big, few, "o_orderkey", "left")


# --- top-k -------------------------------------------------------------------------

def test_summary_bounds_hold():
    rng = random.Random(4)
    for size in (1, 3, 20):
        found, count = heavy.Summary(size), Counter()
        for _ in range(40):
            part = Counter(min(int(rng.expovariate(0.2)), 60) for _ in range(50))
            count.update(part)
            found.add(list(part), list(part.values()))
        assert len(found.counts) <= size
        for k, n in count.items():
            low = found.counts.get(k, 0)
            assert low <= n <= low + found.error


@pytest.mark.parametrize("counters", [30, 5000])
@pytest.mark.parametrize("even", [False, True])
def test_top_counts_are_exact(spark, counters, even):
    rng = random.Random(5)
    keys = [rng.randrange(2000) if even else rng.choice([int(rng.expovariate(0.3)), rng.randrange(5000)]) for _ in range(20_000)] + [None] * 50
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(6)
    want = sorted(Counter(k for k in keys if k is not None).items(), key=lambda x: (-x[1], x[0]))[:5]
    assert [tuple(r) for r in heavy.top_counts(df, "k", 5, counters).collect()] == want
    assert heavy.top_counts(df.limit(0), "k", 5, counters).collect() == []
    few = df.where("k < 3")
    assert [tuple(r) for r in heavy.top_counts(few, "k", 9, counters).collect()] == \
        sorted(Counter(k for k in keys if k is not None and k < 3).items(), key=lambda x: (-x[1], x[0]))


def test_summaries_not_keys_are_shuffled(spark):
    """Rows that leave the tasks follow the counters, not the number of keys."""
    for n in (20_000, 80_000):
        df = spark.range(0, n, numPartitions=4).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
        assert heavy.summaries(df, "k", 100).count() <= 4 * 101
        assert [tuple(r) for r in heavy.top_counts(df, "k", 1, 100).collect()] == [(7, -(-n // 3) + 1)]  # and 7 itself
