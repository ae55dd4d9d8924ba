"""Physical layout jobs.

* clustered / sorted writes and a report of their file sizes,
* global vs per-partition sorts,
* bucketed tables and joins that need no shuffle.

Output folders live under the cluster's shared checkpoint folder
(``cumulo.sources.session.work_path``) unless a path is given.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cumulo.functions.util import names
from cumulo.plans.curves import write_curve
from cumulo.sources.footers import file_report, footers, skipped_groups
from cumulo.sources.session import work_path


# ---------------------------------------------------------------------------
# sorts
# ---------------------------------------------------------------------------

def sort_global(df: DataFrame, cols) -> DataFrame:
    """Total order across partitions: one range-partitioning shuffle (the
    bounds come from a sample, so no single task sorts everything)."""
    return df.orderBy(*names(cols))


def sort_local(df: DataFrame, sort_cols, n: int | None = None, part_cols=None) -> DataFrame:
    """Sort inside partitions only.  With ``part_cols``: one shuffle first that
    brings rows equal in them together (a ``rebalance`` hint: nothing is
    sampled, and AQE splits a hot value and joins small ones); with ``n``, the
    reference's hash ``repartition(n, cols)``; without ``part_cols`` no shuffle
    at all."""
    out = df
    if part_cols:
        out = out.repartition(n, *names(part_cols)) if n else out.hint("rebalance", *names(part_cols))
    return out.sortWithinPartitions(*names(sort_cols))


# ---------------------------------------------------------------------------
# Layouts and their sizes
# ---------------------------------------------------------------------------

def write_layout(df: DataFrame, path: str, sort_cols=None, n: int | None = None,
                 cluster_cols=None, partition_by=None, mode: str = "overwrite",
                 table: str | None = None) -> str:
    """Write ``df`` clustered by ``cluster_cols`` and sorted inside each
    task by ``sort_cols`` (low-cardinality columns first compress best:
    longer runs for parquet's run-length encoding).

    With ``table`` the layout is also saved as a catalog table.
    With ``n`` the clustering is the reference's ``repartition(n, cols)``.
    Without it, a ``rebalance`` hint clusters by the same columns but lets
    AQE split an oversized cluster (one hot date) into several tasks and
    merge tiny ones, so no writer task gets a third of the data.
    """
    out = df
    if cluster_cols:
        out = (out.repartition(n, *names(cluster_cols)) if n
               else out.hint("rebalance", *names(cluster_cols)))
    if sort_cols:
        out = out.sortWithinPartitions(*names(sort_cols))
    w = out.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*names(partition_by))
    if table:  # also register it in the catalog, data under ``path``
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)
    return path


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """Data files under ``path`` (path, length) as a distributed listing.

    Uses the ``binaryFile`` source with the content column pruned, so no
    file is opened; files of zero rows are listed too.
    """
    return (spark.read.format("binaryFile")
                 .option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet")
                 .load(path)
                 .select("path", "length"))


def layout_report(spark: SparkSession, layouts: dict) -> DataFrame:
    """``{name: path}`` -> (layout, size, num_files, num_rows, row_groups),
    one row per layout, from the files' footers: no data is read."""
    out = None
    for name, p in layouts.items():
        part = file_report(footers(spark, p)).withColumn("layout", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.select("layout", "size", "num_files", "num_rows", "row_groups")


def layout_check(spark: SparkSession, layouts: dict) -> DataFrame:
    """The order of written rows, ``{name: (path, sort columns)}``: (layout,
    num_unsorted): rows that come before their predecessor in the same file."""
    out = None
    for name, (path, sort_cols) in layouts.items():
        part = unsorted_rows(spark, path, sort_cols) if sort_cols else spark.range(1).select(F.lit(0).cast("bigint").alias("num_unsorted"))
        part = part.select(F.lit(name).alias("layout"), "num_unsorted")
        out = part if out is None else out.unionByName(part)
    return out


def unsorted_rows(spark: SparkSession, path: str, sort_cols) -> DataFrame:
    """(``num_unsorted``): rows of a folder that come before their predecessor
    in the same file.

    Rows are compared where they are scanned, batch by batch; only the first and
    the last row of a batch are shuffled, to be compared with the next batch's.
    """
    cols = names(sort_cols)
    rows = spark.read.parquet(path).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)],
                                           F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    keys = rows.schema.fields[:len(cols)]
    ends = [StructField(f"{end}{f.name}", f.dataType) for end in ("first", "last") for f in keys]
    schema = StructType([StructField("_file", StringType()), StructField("_at", LongType()), StructField("off", LongType()), *ends])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            file, at = batch.column(len(cols)), batch.column(len(cols) + 1).to_numpy()
            cut = np.ones(n, bool)  # a batch may hold the end of one file and the beginning of another
            cut[1:] = pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False) | (at[1:] != at[:-1] + 1)
            off = np.zeros(n, bool)
            off[1:] = _before(batch.columns[:len(cols)])
            begin = np.flatnonzero(cut)
            last = np.append(begin[1:], n) - 1
            off[begin] = False
            yield pa.RecordBatch.from_arrays(
                [file.take(pa.array(begin)), pa.array(at[begin]), pa.array(np.add.reduceat(off.astype(np.int64), begin)),
                 *[c.take(pa.array(i)) for i in (begin, last) for c in batch.columns[:len(cols)]]], names=schema.names)

    parts = rows.mapInArrow(run, schema)
    first, last = F.struct(*[f"first{f.name}" for f in keys]), F.struct(*[F.col(f"last{f.name}").alias(f"first{f.name}") for f in keys])
    back = F.lag(last).over(Window.partitionBy("_file").orderBy("_at")) > first
    return parts.select("off", F.coalesce(back.cast("bigint"), F.lit(0)).alias("back")).agg(
        F.coalesce(F.sum(F.col("off") + F.col("back")), F.lit(0)).alias("num_unsorted"))


def _before(columns: list[pa.Array]) -> np.ndarray:
    """Does each row but the first sort before its predecessor?  Nulls are least."""
    n = len(columns[0])
    out, equal = np.zeros(n - 1, bool), np.ones(n - 1, bool)
    for c in columns:
        prev, now = c[:-1], c[1:]
        none_prev, none_now = (x.is_null().to_numpy(zero_copy_only=False) for x in (prev, now))
        more = pc.fill_null(pc.greater(prev, now), False).to_numpy(zero_copy_only=False) | (~none_prev & none_now)
        same = pc.fill_null(pc.equal(prev, now), False).to_numpy(zero_copy_only=False) | (none_prev & none_now)
        out |= equal & more
        equal &= same
    return out


def compare_layouts(df: DataFrame, orders: dict, n: int | None = None, cluster_cols=None,
                    base_path: str | None = None, curves: dict | None = None, filters: dict | None = None) -> DataFrame:
    """Write ``df`` once per candidate order and compare (layout, size,
    num_files, num_rows, row_groups, num_unsorted).

    ``orders``: sort columns by name; ``curves``: columns of a space-filling
    order by name (``plans.curves``).  ``filters``: {column: (low, high)}; adds
    ``skipped_<column>``, the row groups such a filter never reads.
    """
    spark = df.sparkSession
    base = base_path or work_path(spark, "layouts")
    paths = {name: write_layout(df, f"{base}/{name}", sort_cols, n=n, cluster_cols=cluster_cols)
             for name, sort_cols in orders.items()}
    for name, cols in (curves or {}).items():
        paths[name] = write_curve(df, f"{base}/{name}", cols, n=n)
    out = layout_report(spark, paths).join(
        layout_check(spark, {name: (path, orders.get(name)) for name, path in paths.items()}), "layout")
    for column, (low, high) in (filters or {}).items():
        kind = df.schema[column].dataType.simpleString()
        rows = None
        for name, path in paths.items():
            part = skipped_groups(footers(spark, path), column, kind, low, high).select(
                F.lit(name).alias("layout"), F.col("skipped").alias(f"skipped_{column}"))
            rows = part if rows is None else rows.unionByName(part)
        out = out.join(rows, "layout")
    return out


# ---------------------------------------------------------------------------
# Bucketed tables
# ---------------------------------------------------------------------------

def write_bucketed(df: DataFrame, n_buckets: int, key, table: str | None = None,
                   path: str | None = None, sort: bool = True) -> str:
    """Save ``df`` as a table bucketed (and sorted) by ``key``.

    Joins and aggregations on ``key`` between tables with the same bucket
    count then read co-located buckets and need no shuffle.  Returns the
    table name (read it with ``spark.table``; the bucket spec lives in the
    catalog, not in the files).
    """
    spark = df.sparkSession
    table = table or f"cumulo_bucketed_{uuid.uuid4().hex[:12]}"
    path = path or work_path(spark, "bucketed", table, unique=False)
    ks = names(key)
    # tasks = buckets, so every bucket is one file (otherwise tasks x buckets)
    w = df.repartition(n_buckets, *ks).write.mode("overwrite").format("parquet").bucketBy(n_buckets, *ks)
    if sort:
        w = w.sortBy(*ks)
    w.option("path", path).saveAsTable(table)
    return table


def drop_bucketed(spark: SparkSession, tables) -> None:
    """Drop tables of ``write_bucketed`` with their files."""
    for t in tables:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {t}").where("col_name = 'Location'").select("data_type").take(1)
        spark.sql(f"DROP TABLE IF EXISTS {t}")
        if rows:  # an external table's files stay behind otherwise
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(rows[0][0])
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bucket_join(spark: SparkSession, tables: list[str], key, how: str = "inner") -> DataFrame:
    """Join bucketed tables on their bucket key, left to right, without a
    shuffle when they share the bucket count.

    At most one table may hold many rows per key; the others should be
    unique per key (a dimension, or a per-key aggregate written bucketed),
    otherwise the join emits every pair of their rows for a key.
    """
    ks = names(key)
    out = spark.table(tables[0])
    for t in tables[1:]:
        out = out.join(spark.table(t), ks, how)
    return out
