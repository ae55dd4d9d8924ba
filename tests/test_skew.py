"""Hot keys: one key holding a third of the rows must not pin one task."""

from pyspark.sql import functions as F

from cumulo.operators import facts, quality
from cumulo.plans.inspect import session_conf

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_details(spark, n=30000):
    # game 0 holds a third of all rows; every row is its own (game, player) key
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("game_id"),
        ((F.col("id") * 7919) % n).alias("player_id"),
        (F.col("id") % 7).alias("pts"))


def test_fact_join_on_hot_parent_is_split(spark):
    details = hot_details(spark)
    parents = spark.range(30000).select(F.col("id").alias("g_id"), (F.col("id") % 5).alias("season"))
    with session_conf(spark, **SKEW_CONF):
        out = facts.build_fact(details, parents, "game_id", "g_id", ["game_id", "player_id"],
                               {"game_id": F.col("game_id"), "player_id": F.col("player_id"),
                                "season": F.col("season"), "pts": F.col("pts")})
        assert len(out.collect()) == 30000  # runs this plan (final AQE plan)
        plan = final_plan(out)
    # dedup ran before the join, so AQE was free to split the hot partition
    assert "isFinalPlan=true" in plan
    assert "skew=true" in plan.replace(" ", "").lower()


def test_dedup_partial_limit_bounds_hot_key(spark):
    # one key repeated 30000 times: each map task forwards at most one row
    df = spark.range(30000).select(F.floor(F.col("id") / 1000000).alias("k"), F.col("id").alias("v")).repartition(6)
    out = quality.dedup(df, ["k"], [F.col("v").asc()])
    assert [tuple(r) for r in out.collect()] == [(0, 0)]
    plan = final_plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
