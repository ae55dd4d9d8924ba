"""Readers for the input tables.

Parquet is the default source: Catalyst pushes filters and the projection
into the scan, so jobs just select what they need.  CSV readers take an
explicit schema (inference costs an extra pass over the file); inference
stays available as an option.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table: ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, infer: bool = False) -> DataFrame:
    """CSV with a header.  With no schema and ``infer=False`` every column is
    a string (the reference's plain read); ``infer=True`` samples types."""
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Temp views named like the tables (for ``spark.sql`` users)."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def date_series(spark: SparkSession, first, last, col: str = "series_date") -> DataFrame:
    """One row per day from ``first`` to ``last`` (inclusive), generated on
    the executors (``range`` + ``date_add``), like ``generate_series``."""
    import datetime as dt

    a = first if isinstance(first, dt.date) else dt.date.fromisoformat(str(first))
    b = last if isinstance(last, dt.date) else dt.date.fromisoformat(str(last))
    n = (b - a).days + 1
    return spark.range(max(n, 0)).select(
        F.date_add(F.lit(a), F.col("id").cast("int")).alias(col))
