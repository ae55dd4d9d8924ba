"""Day-by-day incremental loads (the reference's "insert one day" scripts).

Each day is one Spark job: read the previous day's snapshot partition,
apply the job's daily step, replace the day's partition.  The written table
is the lineage cut between days, so a 365-day backfill is 365 small plans,
not one plan with 365 joins, and a lost executor only recomputes the current
day.

Reruns are safe: the day that is written is overwritten as a whole, also
when the new result is empty.  A day that was loaded and holds no rows
counts as loaded (a marker next to the data says so); a day that was never
loaded is an error for the next one (SURVEY §8-Q5) unless it is the first
day of the run and a seed is given.

Two stores:

* ``PathStore`` – partitioned parquet folder.
* ``BucketedStore`` – catalog table partitioned by day *and bucketed by
  the key*.  Yesterday's snapshot is then read already hash-partitioned,
  so the daily full outer join shuffles only today's (small) side, and the
  join output is written back into the same buckets without another
  shuffle.  All writes are planned with shuffle partitions = buckets
  (``planning``), the condition for Spark to keep the bucketed side.  Use
  it when the snapshot dwarfs a day of events.

A store may be partitioned further (``more_cols``, for instance by metric);
``write(df, day, metric_name="rev")`` then replaces that part of the day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cumulo.functions.util import names, to_pydate
from cumulo.plans.inspect import estimated_bytes, has_join, session_conf
from cumulo.sources.session import work_path


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def partition_path(path: str, partition_col: str, day) -> str:
    return f"{path.rstrip('/')}/{partition_col}={to_pydate(day).isoformat()}"


def _day_filter(partition_col: str, day):
    return F.col(partition_col) == F.to_date(F.lit(to_pydate(day).isoformat()))


def read_day(spark: SparkSession, path: str, partition_col: str, day) -> DataFrame:
    """One day's partition (partition pruning keeps the scan to that folder)."""
    return spark.read.parquet(path).where(_day_filter(partition_col, day))


def write_day(df: DataFrame, path: str, partition_col: str) -> None:
    """Replace the partitions present in ``df`` (dynamic overwrite), for
    writes of many days at once."""
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col)
       .parquet(path))


def _touch(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()


class PathStore:
    """Snapshots as a day-partitioned parquet folder."""

    def __init__(self, spark: SparkSession, path: str, partition_col: str = "snapshot_date",
                 more_cols: tuple[str, ...] = ()):
        self.spark, self.path, self.partition_col, self.more = spark, path, partition_col, tuple(more_cols)

    def _marker(self, day) -> str:
        """Below a folder that Spark's readers skip."""
        return partition_path(f"{self.path.rstrip('/')}/_loaded", self.partition_col, day)

    def _mark(self, day) -> None:
        _touch(self.spark, self._marker(day))

    def exists(self, day) -> bool:
        return path_exists(self.spark, self._marker(day)) or \
            path_exists(self.spark, partition_path(self.path, self.partition_col, day))

    def read(self, day) -> DataFrame:
        return read_day(self.spark, self.path, self.partition_col, day)

    def write(self, df: DataFrame, day=None, **part) -> None:
        """Replace ``day`` (or the ``part`` of it) by ``df``, rows or none.
        Without a day the partitions that ``df`` has rows for are replaced."""
        if day is None:
            write_day(df, self.path, self.partition_col)
            return
        folder = partition_path(self.path, self.partition_col, day)
        rest = list(self.more)
        for c in self.more[:len(part)]:
            folder, rest = f"{folder}/{c}={part[c]}", rest[1:]
        out = df.drop(self.partition_col, *part).write.mode("overwrite").option("partitionOverwriteMode", "static")
        (out.partitionBy(*rest) if rest else out).parquet(folder)
        self._mark(day)

    def replace(self, df: DataFrame, day, **part) -> None:
        """``write`` for rows computed from the day's own partition: they are
        written aside first, since files that are read can't be replaced."""
        aside = work_path(self.spark, "replaced-day")
        df.write.parquet(aside)
        self.write(self.spark.read.schema(df.schema).parquet(aside), day, **part)
        _delete(self.spark, aside)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def buckets_for(df: DataFrame, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Buckets for a table that begins as ``df``: about ``target_bytes`` each
    by Catalyst's estimate, and at least the session's shuffle partitions, so
    that a load uses the cluster (Spark's own limit of buckets is the most).
    Estimates of joins are products; they don't count: give a base table."""
    conf = df.sparkSession.conf
    least = int(conf.get("spark.sql.shuffle.partitions"))
    most = int(conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    size = 0 if has_join(df) else estimated_bytes(df)
    return min(most, max(least, -(-size // target_bytes)))


class BucketedStore(PathStore):
    """Snapshots as a catalog table partitioned by day and bucketed by key.

    The first ``write`` creates the table (``bucketBy(n).partitionBy(day)``,
    data under ``path``); every write replaces the day's partition.  Without
    ``n_buckets`` the first write fixes it from the size of its rows.
    """

    def __init__(self, spark: SparkSession, table: str, path: str, key, n_buckets: int | None = None,
                 partition_col: str = "snapshot_date", more_cols: tuple[str, ...] = ()):
        super().__init__(spark, path, partition_col, more_cols)
        self.table, self.keys, self.n = table, names(key), n_buckets

    def exists(self, day) -> bool:
        self._attach()
        return super().exists(day)

    def _created(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def _attach(self) -> None:
        """Register data already under ``path`` (written by an earlier
        session whose catalog is gone) instead of overwriting it."""
        if self._created() or not self.n or not self._has_partitions():
            return
        ddl = self.spark.read.parquet(self.path)._jdf.schema().toDDL()
        self.spark.sql(
            f"CREATE TABLE {self.table} ({ddl}) USING parquet "
            f"PARTITIONED BY ({', '.join([self.partition_col, *self.more])}) "
            f"CLUSTERED BY ({', '.join(self.keys)}) INTO {self.n} BUCKETS "
            f"LOCATION '{self.path}'")
        self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")

    def _has_partitions(self) -> bool:
        """Data from a committed write: the job's ``_SUCCESS`` marker and at
        least one day folder (a first write that died leaves neither)."""
        root = self.path.rstrip("/")
        if not path_exists(self.spark, f"{root}/_SUCCESS"):
            return False
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/{self.partition_col}=*")
        fs = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.globStatus(pattern)
        return found is not None and len(found) > 0

    def read(self, day) -> DataFrame:
        self._attach()
        return self.spark.table(self.table).where(_day_filter(self.partition_col, day))

    def planning(self):
        """Settings under which a daily step should be planned: shuffles
        sized to the bucket count, so Spark keeps the bucketed snapshot's
        partitioning and moves only the other side (it re-shuffles both
        when the session's shuffle partitions exceed the buckets)."""
        return session_conf(self.spark, **{"spark.sql.shuffle.partitions": str(self.n)})

    def write(self, df: DataFrame, day=None, **part) -> None:
        self._attach()
        self.n = self.n or buckets_for(df)
        fixed = {self.partition_col: to_pydate(day).isoformat(), **part} if day is not None else {}
        if not self._created():
            with self.planning():
                (df.withColumns({c: F.lit(v).cast(df.schema[c].dataType) for c, v in fixed.items() if c in df.columns})
                   .repartition(self.n, *self.keys)  # one file per bucket
                   .write.mode("overwrite").format("parquet")
                   .bucketBy(self.n, *self.keys)
                   .partitionBy(self.partition_col, *self.more)
                   .option("path", self.path)
                   .saveAsTable(self.table))
            if day is not None:
                self._mark(day)
            return
        if day is None:
            with self.planning(), session_conf(self.spark, **{"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
                df.select(*self.spark.table(self.table).columns).write.mode("overwrite").insertInto(self.table)
            return
        if len(part) != len(self.more):
            raise ValueError(f"name the part of the day: {', '.join(self.more)}")
        seen = Observation()
        out = df.withColumns({c: F.lit(v).cast(self.spark.table(self.table).schema[c].dataType) for c, v in fixed.items()})
        out = out.select(*self.spark.table(self.table).columns)  # the insert is positional
        # planned when it runs, inside ``planning``; dynamic overwrite, as a
        # step reads the table it writes, touches only partitions with rows
        with self.planning(), session_conf(self.spark, **{"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").insertInto(self.table)
        if not seen.get["n"]:
            self._clear(fixed)
        self._mark(day)

    def replace(self, df: DataFrame, day, **part) -> None:
        """``write`` for rows computed from the day's own partition: a dynamic
        overwrite writes aside and moves its files when the job commits."""
        self.write(df, day, **part)

    def bytes_per_bucket(self, day) -> int:
        """Average size of a bucket of a day, from the files' lengths."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(partition_path(self.path, self.partition_col, day))
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return int(fs.getContentSummary(p).getLength()) // self.n if fs.exists(p) else 0

    def refined(self, day, target_bytes: int = 256 * 1024 * 1024) -> "BucketedStore":
        """The store to go on with after ``day``: this one while its buckets are
        within ``target_bytes``, else a new one whose buckets are a power of two
        smaller and which holds ``day``.

        A hash modulo k n tells apart what it leaves together modulo n, so every
        bucket is split by the task that reads it: no shuffle.  Earlier days
        stay where they are; the next day reads ``day`` from the new store.
        """
        factor, size = 1, self.bytes_per_bucket(day)
        while size > target_bytes * factor:
            factor *= 2
        most = int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
        while factor > 1 and self.n * factor > most:
            factor //= 2
        if factor == 1:
            return self
        n = self.n * factor
        finer = type(self)(self.spark, f"{self.table}_{n}", f"{self.path.rstrip('/')}_{n}", self.keys, n, self.partition_col, self.more)
        if not finer.exists(day):
            (self.split(day, n).write.mode("overwrite").format("parquet").bucketBy(n, *self.keys)
                 .partitionBy(self.partition_col, *self.more).option("path", finer.path).saveAsTable(finer.table))
            finer._mark(day)
        return finer

    def split(self, day, n: int) -> DataFrame:
        """The day's rows for a write into ``n`` buckets, a multiple of this
        store's: one task per bucket, as read."""
        if n % self.n:
            raise ValueError(f"{n} buckets don't refine {self.n}")
        return self.read(day)

    def _clear(self, fixed: dict) -> None:
        """Remove one partition: what a rerun without rows replaces."""
        spec = ", ".join(f"{c} = '{v}'" for c, v in fixed.items())
        self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({spec})")
        folder = "/".join([self.path.rstrip("/"), *(f"{c}={v}" for c, v in fixed.items())])
        _delete(self.spark, folder)
        self.spark.catalog.refreshTable(self.table)

    def release(self, day) -> DataFrame:
        """The day's rows as plain files, and no catalog entry any more: for
        jobs whose table is only a means."""
        schema = self.spark.table(self.table).schema
        self.spark.sql(f"DROP TABLE {self.table}")  # external: the files stay
        return self.spark.read.schema(schema).parquet(self.path).where(_day_filter(self.partition_col, day))


def days_between(first, last) -> list[dt.date]:
    a, b = to_pydate(first), to_pydate(last)
    return [a + dt.timedelta(days=i) for i in range((b - a).days + 1)]


def run_daily(spark: SparkSession, store, first_day, last_day,
              step: Callable[[DataFrame, dt.date], DataFrame],
              partition_col: str = "snapshot_date", seed: DataFrame | None = None) -> DataFrame:
    """Load ``first_day .. last_day`` one day at a time into ``store``.

    ``store`` is a ``PathStore``/``BucketedStore`` or a folder path (a
    ``PathStore`` on ``partition_col``).  ``step(prev, day)`` gets the
    previous day's snapshot (``seed`` before the first day when that
    partition does not exist) and returns the day's rows including the
    partition column.  Returns the last day's partition read back.
    """
    if isinstance(store, str):
        store = PathStore(spark, store, partition_col)
    days = days_between(first_day, last_day)
    if not days:
        raise ValueError(f"empty day range {first_day} .. {last_day}")
    for i, d in enumerate(days):
        prev_day = d - dt.timedelta(days=1)
        if store.exists(prev_day):
            prev = store.read(prev_day)
        elif i == 0 and seed is not None:
            prev = seed
        else:
            raise ValueError(f"snapshot for {prev_day} missing; load it first")
        store.write(step(prev, d), d)
    return store.read(days[-1])
