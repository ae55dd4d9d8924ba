"""What parquet files say of themselves (§2.2 ``.files``, J15, J26).

A data source that reads the footers of a folder's files: one row per file, row
group and column with rows, bytes, encodings, nulls, least and greatest value.
No page is read.  Files are dealt to tasks in groups; the folder may be on any
file system that pyarrow knows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Files whose footers one task reads.
FILES_PER_TASK = 64

SCHEMA = ("path string, file_bytes bigint, row_group int, num_rows bigint, column string, encodings string, "
          "compressed bigint, uncompressed bigint, nulls bigint, least string, greatest string")


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


def _text(value) -> str | None:
    """A statistic as text that Spark casts back to the column's type."""
    if value is None:
        return None
    if isinstance(value, bytes):
        return value.decode("utf-8", "replace")
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return str(value)


class FooterReader(DataSourceReader):
    def __init__(self, path: str, per_task: int):
        self.path, self.per_task = path, per_task

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        names = sorted(f.path for f in found if f.is_file and f.path.endswith(".parquet")
                       and not any(p.startswith(("_", ".")) for p in f.path[len(root):].split("/")))
        return [_Files(names[i:i + self.per_task]) for i in range(0, len(names), self.per_task)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(self.path)
        for path in partition.paths:
            size = system.get_file_info(path).size
            with system.open_input_file(path) as f:
                meta = pq.ParquetFile(f).metadata
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                for c in range(group.num_columns):
                    col = group.column(c)
                    stats = col.statistics if col.is_stats_set else None
                    bounds = (stats.min, stats.max) if stats is not None and stats.has_min_max else (None, None)
                    nulls = stats.null_count if stats is not None and stats.has_null_count else None
                    yield (path, size, g, group.num_rows, col.path_in_schema, ",".join(sorted(col.encodings)),
                           col.total_compressed_size, col.total_uncompressed_size, nulls, _text(bounds[0]), _text(bounds[1]))
            if not meta.num_row_groups:  # a file without rows is a file
                yield (path, size, None, 0, None, None, 0, 0, 0, None, None)


class ParquetFooters(DataSource):
    @classmethod
    def name(cls) -> str:
        return "parquet_footers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        path = self.options.get("path", "")
        return FooterReader(path if "://" in path or path.startswith("file:") else f"file://{path}",
                            int(self.options.get("files_per_task", FILES_PER_TASK)))


def footers(spark: SparkSession, path: str, files_per_task: int = FILES_PER_TASK) -> DataFrame:
    """Footers of the parquet files under ``path``; see the module."""
    spark.dataSource.register(ParquetFooters)
    return spark.read.format("parquet_footers").option("files_per_task", str(files_per_task)).load(path)


def file_report(found: DataFrame) -> DataFrame:
    """(``size``, ``num_files``, ``num_rows``, ``row_groups``) of all files."""
    groups = found.groupBy("path", "row_group").agg(F.max("file_bytes").alias("size"), F.max("num_rows").alias("n"))
    files = groups.groupBy("path").agg(F.max("size").alias("size"), F.sum("n").alias("n"), F.count("row_group").alias("g"))
    return files.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count(F.lit(1)).alias("num_files"),
                     F.coalesce(F.sum("n"), F.lit(0)).alias("num_rows"), F.coalesce(F.sum("g"), F.lit(0)).alias("row_groups"))


def column_report(found: DataFrame, schema) -> DataFrame:
    """One row per column: rows, nulls, bytes, encodings, least and greatest
    value as text (null where the writer keeps no statistics).  ``schema`` is the
    files' Spark schema, which says how values compare."""
    out = None
    for field in schema.fields:
        kind = field.dataType.simpleString()
        one = found.where(F.col("column") == field.name).agg(
            F.coalesce(F.sum("num_rows"), F.lit(0)).alias("num_rows"), F.sum("nulls").alias("nulls"),
            F.coalesce(F.sum("compressed"), F.lit(0)).alias("compressed"), F.array_join(F.array_sort(F.collect_set("encodings")), ";").alias("encodings"),
            F.min(F.col("least").cast(kind)).cast("string").alias("least"), F.max(F.col("greatest").cast(kind)).cast("string").alias("greatest"))
        one = one.withColumn("column", F.lit(field.name))
        out = one if out is None else out.unionByName(one)
    return out.select("column", "num_rows", "nulls", "compressed", "encodings", "least", "greatest")


def skipped_groups(found: DataFrame, column: str, kind: str, low, high) -> DataFrame:
    """(``row_groups``, ``skipped``): row groups, and those that a filter
    ``low <= column <= high`` never reads."""
    one = found.where(F.col("column") == column)
    out = (F.col("greatest").cast(kind) < F.lit(low).cast(kind)) | (F.col("least").cast(kind) > F.lit(high).cast(kind))
    return one.agg(F.count(F.lit(1)).alias("row_groups"), F.coalesce(F.sum(out.cast("bigint")), F.lit(0)).alias("skipped"))
