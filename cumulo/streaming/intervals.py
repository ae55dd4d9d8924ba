"""Type-2 history loaded step by step (J12, §2.3 overwrite).

Two tables hold the history.  *Open* has one row per entity: the value of its
last run with the first and last order value.  *Closed* has the runs that have
ended, in one partition per order value that ended them.  A load reads and
replaces the open rows and adds one partition of closed ones; partitions of
earlier loads are never written again.

Rows of an order value that was passed before (a season that arrives late) may
split a run, extend one or join two.  Where the neighbours of such a row lie is
known by the source rows alone, so the entities concerned, and they alone, are
worked out again from the source; of the closed partitions only those in which
one of their runs changes are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cumulo.operators.history import scd2
from cumulo.sources.session import checkpoint_root
from cumulo.streaming.daily import PathStore, _delete, path_exists


class IntervalStore:
    """History of ``entity``'s ``tracked`` value over ``order`` under ``path``."""

    def __init__(self, spark: SparkSession, path: str, entity: str, order: str, tracked: str,
                 start_col: str = "start_date", end_col: str = "end_date"):
        self.spark, self.path = spark, path.rstrip("/")
        self.entity, self.order, self.tracked = entity, order, tracked
        self.start, self.end = start_col, end_col
        self.columns = [entity, tracked, start_col, end_col]

    # -- tables ----------------------------------------------------------------
    def _folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def _loaded(self) -> list[str]:
        """Order values loaded so far, oldest first (names of open tables)."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self._folder("open"))
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(n for n in names if path_exists(self.spark, f"{self._folder('open')}/{n}/_SUCCESS"))

    def _open_path(self, version: str) -> str:
        return f"{self._folder('open')}/{version}"

    def open_rows(self) -> DataFrame | None:
        versions = self._loaded()
        return self.spark.read.parquet(self._open_path(versions[-1])) if versions else None

    def closed_rows(self) -> DataFrame | None:
        if not path_exists(self.spark, self._folder("closed")):
            return None
        return self.spark.read.parquet(self._folder("closed"))

    def history(self) -> DataFrame:
        """(entity, tracked, start, end): all runs."""
        rows = self.open_rows()
        if rows is None:
            raise ValueError("nothing is loaded yet")
        rows = rows.select(*self.columns)
        closed = self.closed_rows()
        return rows if closed is None else rows.unionByName(closed.select(*self.columns))

    def _write_open(self, rows: DataFrame, value) -> None:
        """A new version of the open table: what commits a load.  The one before
        stays until the next load."""
        versions = self._loaded()
        now = f"{int(versions[-1].split('-')[0]) + 1 if versions else 0:012d}-{value}"
        rows.select(*self.columns).write.mode("overwrite").parquet(self._open_path(now))
        for old in versions[:-1]:
            _delete(self.spark, self._open_path(old))

    # -- loads -----------------------------------------------------------------
    def load(self, rows: DataFrame, value) -> None:
        """Load the rows of one order value, later than all before: (entity,
        tracked), one row per entity.  Loading the last value again replaces
        what it did."""
        e, v = self.entity, self.tracked
        at = F.lit(value)
        now = rows.select(e, F.col(v).alias("_new"))
        versions = self._loaded()
        if versions and versions[-1].split("-", 1)[1] == str(value):
            _delete(self.spark, self._open_path(versions[-1]))
        old = self.open_rows()
        if old is None:
            self._write_open(now.select(e, F.col("_new").alias(v), at.alias(self.start), at.alias(self.end)), value)
            return
        o, n = old.alias("o"), now.withColumn("_seen", F.lit(True)).alias("n")
        checkpoint_root(self.spark)
        # open rows and the load's rows: both branches below read what is joined once
        j = o.join(n, F.col(f"o.{e}").eqNullSafe(F.col(f"n.{e}")), "full_outer").select(
            F.when(F.col("n._seen"), F.col(f"n.{e}")).otherwise(F.col(f"o.{e}")).alias(e),
            F.col(f"o.{v}").alias("_old"), F.col(f"o.{self.start}").alias("_start"), F.col(f"o.{self.end}").alias("_end"),
            F.col("n._new").alias("_new"), F.coalesce("n._seen", F.lit(False)).alias("_seen"),
            F.col(f"o.{self.end}").isNotNull().alias("_had")).checkpoint()
        late = j.where("_seen and _had").where(F.col("_end") > at).limit(1).count()
        if late:
            raise ValueError(f"{value!r} was passed before: use load_late")
        same = F.col("_old").eqNullSafe(F.col("_new"))
        ends = F.col("_seen") & F.col("_had") & ~same
        keep = F.col("_had") & ~ends
        self._closed_store().write(j.where(ends).select(
            e, F.col("_old").alias(v), F.col("_start").alias(self.start), F.col("_end").alias(self.end)), value)
        self._write_open(j.select(
            e, F.when(keep, F.col("_old")).otherwise(F.col("_new")).alias(v),
            F.when(keep, F.col("_start")).otherwise(at).alias(self.start),
            F.when(F.col("_seen"), at).otherwise(F.col("_end")).alias(self.end)), value)

    def _closed_store(self) -> "_Closed":
        return _Closed(self.spark, self._folder("closed"))

    def load_late(self, source: DataFrame, entities: DataFrame) -> list:
        """Work out the ``entities`` (one column) again from ``source`` (all
        rows: entity, order, tracked).  Returns the closed partitions replaced."""
        e = self.entity
        checkpoint_root(self.spark)
        touched = entities.select(e).distinct().checkpoint()
        key = F.col(f"s.{e}").eqNullSafe(F.col(f"t.{e}"))
        rows = source.select(e, self.order, self.tracked).alias("s").join(touched.alias("t"), key, "left_semi")
        runs = scd2(rows, e, self.order, self.tracked, start_col=self.start, end_col=self.end)
        # a run is closed by the first row of the next one
        after = F.lead(self.start).over(Window.partitionBy(e).orderBy(self.start))
        runs = runs.withColumn("_closed_by", after).checkpoint()
        old = self.open_rows()
        opened = runs.where("_closed_by is null").select(*self.columns)
        kept = old.alias("s").join(touched.alias("t"), key, "left_anti").select(*self.columns)
        new_closed = runs.where("_closed_by is not null")
        closed, part = self.closed_rows(), _Closed.column
        done, before = [], None
        if closed is not None:
            closed = closed.withColumn(part, F.col(part).cast("string"))
            before = closed.alias("s").join(touched.alias("t"), key, "left_semi").select(*self.columns, part).checkpoint()
        same = [*self.columns, part]
        fresh = new_closed.withColumn(part, F.col("_closed_by").cast("string")).select(*same)
        parts = fresh if before is None else fresh.exceptAll(before).unionByName(before.exceptAll(fresh))
        for value in sorted(r[part] for r in parts.select(part).distinct().collect()):  # order values, not rows
            rows = fresh.where(F.col(part) == value).select(*self.columns)
            if closed is not None:
                others = closed.where(F.col(part) == value).alias("s").join(touched.alias("t"), key, "left_anti")
                rows = rows.unionByName(others.select(*self.columns))
            self._closed_store().replace(rows, value)
            done.append(value)
        self._write_open(kept.unionByName(opened), self._loaded()[-1].split("-", 1)[1])
        return done


class _Closed(PathStore):
    """Closed runs, one folder per order value that closed them."""

    column = "closed_by"

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, self.column)

    def _path(self, value) -> str:
        return f"{self.path}/{self.column}={value}"

    def write(self, df: DataFrame, day=None, **part) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self._path(day))
