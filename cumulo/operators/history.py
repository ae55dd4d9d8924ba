"""Type-2 history: collapse consecutive equal values per entity into
(start, end) rows (J12).

Gaps and islands, computed so that no single task has to see all rows of
one entity (an entity may hold a large share of the table):

1. Every row gets a chunk number computed from its order value.  Chunks are
   ranges of about equal rows of the whole table: an entity with a third of
   the rows is cut into a third of the chunks, wherever its values lie, while
   a small table, or an entity with few rows, has few.  The cuts come from one
   aggregate and are literals of the plan: the same on every run.
2. One hash exchange on (entity, chunk).  Inside: ``lag`` and a running max
   of change positions (window functions over a bounded chunk).
3. One summary row per (entity, chunk) by an aggregate on the same
   partitioning: first and last value, last local change, and the bounds of the
   chunk's leading run.  A window over the summary (one row per chunk) decides
   whether a chunk's first row starts an island and which island start carries
   into its leading run.
4. Rows after a local change know their island already; leading runs come from
   the summary.  Both meet in one grouped min/max per (entity, island start)
   with map-side partial aggregation.

``null_safe=True`` (default) treats NULL as an ordinary value: equal
neighbours never split, ``NULL -> A`` and ``A -> NULL`` both do.
``null_safe=False`` reproduces the reference query: a row after a NULL
always starts a new streak, ``A -> NULL`` keeps A's streak id, and the
value is part of the grouping key (SURVEY §8-Q9).

The order column must be unique per entity (SURVEY §8-Q10); check with
``quality.assert_unique`` when the input is not trusted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _changed(prev: Column, cur: Column, null_safe: bool) -> Column:
    if null_safe:
        return ~prev.eqNullSafe(cur)
    return prev.isNull() | F.coalesce(prev != cur, F.lit(False))


#: Rows of a chunk, and the most chunks a table is cut into (a square: cuts are
#: looked up in two steps).
CHUNK_ROWS, MOST_CHUNKS = 1_000_000, 64 * 64


def _order_number(df: DataFrame, order: str) -> Column | None:
    """The order value as a double that keeps its order; None for other types."""
    kind = df.schema[order].dataType.typeName()
    if kind == "date":
        return F.unix_date(order).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(order).cast("timestamp")).cast("double")
    if kind in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        return F.col(order).cast("double")
    return None


def order_cuts(df: DataFrame, order: str, chunk_rows: int = CHUNK_ROWS) -> list[float]:
    """Order values at which chunks of about ``chunk_rows`` rows of ``df`` begin:
    the least for a small table, at most ``MOST_CHUNKS``.  One aggregate."""
    number = _order_number(df, order)
    if number is None:
        return []
    grid = [i / MOST_CHUNKS for i in range(1, MOST_CHUNKS)]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("least"),
                 F.percentile_approx(number, grid, 10 * MOST_CHUNKS).alias("cuts")).first()
    if row["least"] is None:
        return []
    chunks = min(MOST_CHUNKS, row["n"] // chunk_rows + 1)
    return sorted({row["least"], *(row["cuts"][i * MOST_CHUNKS // chunks - 1] for i in range(1, chunks))})


def order_chunk(df: DataFrame, order: str, width: int | None = None, cuts: list[float] | None = None) -> Column:
    """The chunk of a row, growing with the order value: how many ``cuts`` it
    reaches, or ranges of a fixed ``width`` (months for dates and timestamps).
    A NULL has a chunk of its own, before all others."""
    none = F.lit(-(1 << 62)).cast("bigint")
    if width is not None:
        dated = df.schema[order].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
        value = F.year(order) * 12 + F.month(order) if dated else F.col(order)
        return F.coalesce(F.floor(value / F.lit(width)).cast("bigint"), none)
    number = _order_number(df, order)
    if number is None or not cuts:
        return F.when(F.col(order).isNull(), none).otherwise(F.lit(0).cast("bigint"))

    def reached(some: Column) -> Column:
        return F.size(F.filter(some, lambda x: x <= number))

    step = 64
    blocks = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    lists = F.array(*[F.array(*[F.lit(float(x)) for x in b]) for b in blocks])
    block = F.greatest(reached(F.array(*[F.lit(float(b[0])) for b in blocks])) - 1, F.lit(0))
    return F.when(F.col(order).isNull(), none).otherwise((block * step + reached(F.get(lists, block))).cast("bigint"))


def scd2(df: DataFrame, entity: str, order: str, tracked: str, null_safe: bool = True,
         start_col: str = "start_date", end_col: str = "end_date", chunk_width: int | None = None,
         chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(entity, tracked, start_col, end_col): one row per run of equal values.

    ``chunk_rows``: rows of the table per chunk, see ``order_cuts``; with
    ``chunk_width`` chunks are ranges of so many order values (months for dates)
    and no aggregate is run.
    """
    o, v = F.col(order), F.col(tracked)
    cuts = order_cuts(df, order, chunk_rows) if chunk_width is None else None
    base = df.select(entity, order, tracked).withColumn("_chunk", order_chunk(df, order, chunk_width, cuts))

    w = Window.partitionBy(entity, "_chunk").orderBy(order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = base.withColumn("_rn", F.row_number().over(w)).withColumn("_prev", F.lag(tracked).over(w))
    local_change = (F.col("_rn") > 1) & _changed(F.col("_prev"), v, null_safe)
    local = local.withColumn("_loc_start", F.max(F.when(local_change, o)).over(running)).withColumn(
        "_leads", (F.max(F.when(local_change, F.lit(1))).over(running)).isNull())

    # One row per chunk; no exchange, the rows are partitioned by these keys.  A
    # leading run has one value and, unless null-safe, perhaps a NULL at its end.
    leads = F.col("_leads")
    summary = local.groupBy(entity, "_chunk").agg(
        F.max(F.when(F.col("_rn") == 1, o)).alias("_first_o"), F.max_by(v, -F.col("_rn")).alias("_first_v"),
        F.max_by(v, F.col("_rn")).alias("_last_v"), F.max("_loc_start").alias("_last_change"),
        *[f(F.when(leads & some, x)).alias(f"_{name}_{c}") for name, some in (("value", v.isNotNull()), ("null", v.isNull()))
          for c, f, x in (("s", F.min, o), ("t", F.max, o), ("n", F.count, F.lit(1)))])
    ws = Window.partitionBy(entity).orderBy("_chunk")
    first_change = (F.lag("_chunk").over(ws).isNull()
                    | _changed(F.lag("_last_v").over(ws), F.col("_first_v"), null_safe))
    summary = (summary.withColumn("_first_change", first_change)
                      .withColumn("_own", F.coalesce(F.col("_last_change"),
                                                     F.when(F.col("_first_change"), F.col("_first_o"))))
                      .withColumn("_inherited", F.last("_own", ignorenulls=True).over(
                          ws.rowsBetween(Window.unboundedPreceding, -1))))
    island = F.when(F.col("_first_change"), F.col("_first_o")).otherwise(F.col("_inherited"))
    nothing = F.lit(None).cast(df.schema[tracked].dataType)
    runs = F.array(*[F.struct(value.alias("v"), F.col(f"_{name}_s").alias("s"), F.col(f"_{name}_t").alias("t"), F.col(f"_{name}_n").alias("n"))
                     for name, value in (("value", F.col("_first_v")), ("null", nothing))])
    led = (summary.select(entity, island.alias("_island"), F.explode(runs).alias("_run")).where("_run.n > 0")
                  .select(entity, "_island", F.col("_run.v").alias(tracked), F.col("_run.s").alias("_s"), F.col("_run.t").alias("_t")))
    settled = local.where(~leads).select(entity, F.col("_loc_start").alias("_island"), tracked, o.alias("_s"), o.alias("_t"))
    return (settled.unionByName(led)
                   .groupBy(entity, "_island", tracked)
                   .agg(F.min("_s").alias(start_col), F.max("_t").alias(end_col))
                   .select(entity, tracked, start_col, end_col))


def scd2_windowed(df: DataFrame, entity: str, order: str, tracked: str, null_safe: bool = True,
                  start_col: str = "start_date", end_col: str = "end_date") -> DataFrame:
    """The single-window form (one shuffle on the entity).  Same result as
    ``scd2`` and cheaper, but all rows of an entity meet in one task: only for
    inputs whose entities are bounded (a player's seasons), not for hot keys."""
    w = Window.partitionBy(entity).orderBy(order)
    changed = (F.row_number().over(w) == 1) | _changed(F.lag(tracked).over(w), F.col(tracked), null_safe)
    streak = F.sum(F.when(changed, 1).otherwise(0)).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = df.select(entity, order, tracked).withColumn("_streak", streak)
    # a null-safe streak has one value: grouping by it keeps the aggregate
    # fixed-width (hash aggregate)
    return (rows.groupBy(entity, "_streak", tracked)
                .agg(F.min(order).alias(start_col), F.max(order).alias(end_col))
                .select(entity, tracked, start_col, end_col))
