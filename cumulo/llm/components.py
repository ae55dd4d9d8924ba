"""Distributed connected components by alternating large and small stars.

Every round rewrites the links so that each node points at the smallest node
it knows; the number of rounds is logarithmic in practice, links never grow
in number.  Each half round is written to the shared work folder, so a lost
executor costs one half round, and joins start from plain scans, where AQE
splits the partitions of a node that a third of all links share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.llm.common import discard, stage


def _ordered(links: DataFrame) -> DataFrame:
    """Links as (u, v) with u > v, each once."""
    return (links.filter("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _star(links: DataFrame, large: bool) -> DataFrame:
    near = links
    if large:
        near = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m") if large else F.col("m"))
    # also by a hash: else the join would take over the aggregate's partitions,
    # and AQE splits those of a hot node only where the join has its own
    met = (near.filter("v > u") if large else near).withColumn("h", F.xxhash64("u")).join(
        least.withColumn("g", F.xxhash64("n")), (F.col("h") == F.col("g")) & (F.col("u") == F.col("n")))
    moved = [F.struct(F.col("v").alias("u"), F.col("m").alias("v"))]
    if not large:
        moved.append(F.struct("u", F.col("m").alias("v")))
    return stage(_ordered(met.select(F.inline(F.array(*moved)))), "star")


def _are_stars(links: DataFrame) -> bool:
    """Does every node point at one other, and nobody at those that point?  The
    links are done then."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def stars(links: DataFrame) -> DataFrame:
    """(``u``, ``v``) of every node that is not the smallest of its component:
    ``v`` is the smallest.  ``links`` are such pairs with u > v; stars of earlier
    links with new ones among them take fewer rounds than all links."""
    now, own = links, False
    while not _are_stars(now):
        for large in (True, False):
            then = _star(now, large)
            if own:
                discard(now)
            now, own = then, True
    return now


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``root``) of every node that has a link: ``root`` is the
    smallest node reachable.  Links with a null end, loops and repeats are
    ignored; no links give an empty result."""
    first = stage(_ordered(links.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna()), "links")
    now = stars(first)
    if now is not first:
        discard(first)
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
