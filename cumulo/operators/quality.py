"""Data-quality jobs: duplicate keys, dedup, uniqueness, cardinality, time range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulo.functions.util import as_col, names


def duplicate_report(df: DataFrame, keys, count_col: str = "n") -> DataFrame:
    """Keys that occur more than once, with their row count.

    A plain grouped count: partial counts are combined map-side, so a hot
    key costs one row per map task in the shuffle.
    """
    ks = names(keys)
    return (df.groupBy(*ks).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))


def order_columns(df: DataFrame, keys, order_by=None) -> list[Column]:
    """A total order for a dedup: the given sort columns, else every
    non-key column ascending (rows equal in all columns are interchangeable)."""
    if order_by is not None:
        return [as_col(c) for c in ([order_by] if isinstance(order_by, (str, Column)) else order_by)]
    ks = set(names(keys))
    return [F.col(c).asc_nulls_first() for c in df.columns if c not in ks]


def dedup(df: DataFrame, keys, order_by=None, rank_col: str = "_cumulo_rn") -> DataFrame:
    """Keep the first row per key under ``order_by`` (default: all columns).

    ``row_number() == 1`` lets Catalyst plan a WindowGroupLimit: each map
    task keeps one row per key before the shuffle, so heavy duplication
    of one key does not reach a single reducer.
    """
    ks = names(keys)
    w = Window.partitionBy(*ks).orderBy(*order_columns(df, ks, order_by))
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) == 1).drop(rank_col))


def assert_unique(df: DataFrame, keys) -> None:
    """Raise if any key occurs twice (a primary-key check Spark does not
    enforce).  Runs one aggregate job; only one duplicate is fetched."""
    dup = duplicate_report(df, keys).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {tuple(dup[0])[:-1]} occurs {dup[0][-1]} times")


def cardinality(df: DataFrame, cols, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """One row with the distinct count of each column."""
    aggs = [(F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)).alias(f"n_{c}")
            for c in names(cols)]
    return df.agg(*aggs)


def time_range(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """First and last value of a time column."""
    return df.agg(F.min(ts).alias(f"{prefix}first_ts"), F.max(ts).alias(f"{prefix}last_ts"))


#: Types whose bounds parquet footers keep in a form that Spark pushes down.
_IN_FOOTERS = ("boolean", "byte", "short", "integer", "long", "float", "double", "date")


def footer_bounds(spark, path: str, cols) -> DataFrame:
    """(``num_rows``, ``min_<col>``, ``max_<col>`` ...) of a parquet folder,
    answered from file footers: the aggregates are pushed into the scan and no
    column is read.

    Only for columns whose type has exact bounds in footers; others (timestamps,
    strings, decimals) are an error here: read them with ``time_range``.  Rows,
    bounds and nulls are as the files say; NaN in a float column is not in its
    bounds.
    """
    from cumulo.plans.inspect import session_conf

    with session_conf(spark, **{"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}):
        df = spark.read.parquet(path)
        for c in names(cols):
            if df.schema[c].dataType.typeName() not in _IN_FOOTERS:
                raise ValueError(f"{c}: footers have no exact bounds for {df.schema[c].dataType.simpleString()}")
        out = df.agg(F.count(F.lit(1)).alias("num_rows"),
                     *[f(c).alias(f"{n}_{c}") for c in names(cols) for n, f in (("min", F.min), ("max", F.max))])
        out._jdf.queryExecution().executedPlan()  # made under these settings, kept with the DataFrame
    return out
