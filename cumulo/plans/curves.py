"""Space-filling write orders.

A Z-order key interleaves the bits of several columns' range ranks, so that
files and row groups are narrow in every one of them, where a plain sort is
narrow in its first column only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulo.functions.util import names

#: Bits of a column's range rank: 2**BITS - 1 cuts per column, a fixed number.
BITS = 6


def range_cuts(df: DataFrame, cols, bits: int = BITS, accuracy: int = 10_000) -> dict[str, list]:
    """Values that cut each column into 2**bits ranges of about equal rows, from
    one aggregate over all rows."""
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    aggs = []
    for c in names(cols):
        aggs.append(F.percentile_approx(_number(df, c), share, accuracy).alias(c))
    row = df.agg(*aggs).first()  # a fixed number of values
    return {c: sorted(set(row[c] or [])) for c in names(cols)}


def _number(df: DataFrame, col: str) -> Column:
    """A column's value as a number that keeps its order: dates as days,
    timestamps as microseconds, strings as their first six bytes."""
    kind = df.schema[col].dataType.typeName()
    c = F.col(col)
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.encode(F.substring(c, 1, 6), "UTF-8")), 12, "0").substr(1, 12), 16, 10).cast("double")
    return c.cast("double")


def range_rank(df: DataFrame, col: str, cuts: list) -> Column:
    """Number of cuts at or below a value; nulls rank lowest."""
    value = _number(df, col)
    if not cuts:
        return F.lit(0).cast("bigint")
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(float(x)) for x in cuts]), lambda x: x <= value)), F.lit(0)).cast("bigint")


def interleave(ranks: list[Column], bits: int = BITS) -> Column:
    """Z-order key: bit i of every rank, highest first, in turn."""
    key = F.lit(0).cast("bigint")
    n = len(ranks)
    if n * bits > 62:
        raise ValueError("too many columns for one key")
    for i in range(bits):
        for j, rank in enumerate(ranks):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(bit, i * n + (n - 1 - j)))
    return key


def z_key(df: DataFrame, cols, bits: int = BITS) -> Column:
    cuts = range_cuts(df, cols, bits)
    return interleave([range_rank(df, c, cuts[c]) for c in names(cols)], bits)


def write_curve(df: DataFrame, path: str, cols, bits: int = BITS, n: int | None = None, max_rows: int | None = None) -> str:
    """Write ``df`` in Z-order of ``cols``: ranges of the key per task (the
    bounds come from a sample, so equal keys don't fill one task beyond their
    share), sorted by it inside; ``max_rows`` per file."""
    keyed = df.withColumn("_z", z_key(df, cols, bits))
    ties = ["_z", *names(cols)]
    placed = keyed.repartitionByRange(n, *ties) if n else keyed.repartitionByRange(*ties)
    out = placed.sortWithinPartitions(*ties).drop("_z").write.mode("overwrite").format("parquet")
    if max_rows:
        out = out.option("maxRecordsPerFile", max_rows)
    out.save(path)
    return path
