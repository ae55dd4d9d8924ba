"""Exact distinct sets that can be merged.

Daily unique visitors do not add up to monthly ones; daily *sets* do.  The
members of a key and day are split into buckets of 32,768 ids; a bucket is a
bitmap, or, while it has few members, the sorted list of their positions.  A
day's sets are appended once; any span of days is counted by merging the sets,
and no earlier events are read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.functions.dates import day
from cumulo.functions.util import names
from cumulo.operators.cumulative import _day_events

#: Members up to which a bucket is a list (2 bytes each, a bitmap has 4,096).
SPARSE = 1024


def daily_sets(events: DataFrame, key, member: str, ts: str, first=None, last=None, date_col: str = "date_partition") -> DataFrame:
    """(key, date_col, ``bucket``, ``positions``, ``bitmap``): the distinct
    members (whole numbers) of every key and day; one of the last two is null.

    Null members belong to no set.  Every member reaches its bucket once per
    map task; a bucket's state is bounded, however many rows a key has.
    """
    ks = names(key)
    ev = _day_events(events, ts, first, last).where(F.col(member).isNotNull())
    member = F.col(member).cast("bigint")
    seen = ev.select(*ks, day(ts).alias(date_col), F.bitmap_bucket_number(member).alias("bucket"),
                     F.bitmap_bit_position(member).alias("_at")).distinct()
    sets = seen.groupBy(*ks, date_col, "bucket").agg(
        F.count(F.lit(1)).alias("_n"), F.bitmap_construct_agg("_at").alias("bitmap"), F.collect_list("_at").alias("_list"))
    few = F.col("_n") <= SPARSE
    return sets.select(*ks, date_col, "bucket", F.when(few, F.sort_array("_list").cast("array<smallint>")).alias("positions"),
                       F.when(~few, F.col("bitmap")).alias("bitmap"))


def merge_sets(sets: DataFrame, group) -> DataFrame:
    """(group, ``bucket``, ``bitmap``): the union of the sets of each group."""
    gs = names(group)
    few = (sets.where(F.col("positions").isNotNull()).select(*gs, "bucket", F.explode("positions").alias("_at"))
               .withColumn("_at", F.col("_at").cast("bigint")).groupBy(*gs, "bucket").agg(F.bitmap_construct_agg("_at").alias("bitmap")))
    many = sets.where(F.col("bitmap").isNotNull()).select(*gs, "bucket", "bitmap")
    return few.unionByName(many).groupBy(*gs, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_members(sets: DataFrame, group, out_col: str = "n_members") -> DataFrame:
    """Distinct members per group: exact, whatever days or keys were merged."""
    gs = names(group)
    return merge_sets(sets, gs).groupBy(*gs).agg(F.sum(F.bitmap_count("bitmap")).alias(out_col))
