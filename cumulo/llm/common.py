"""Helpers the training-data operators share."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.sources.session import work_path
from cumulo.sources.tables import read_table

#: Fixed by the task: a word is a maximal run of anything else than these.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The ``documents`` table, only the columns a job needs."""
    df = read_table(spark, sf_dir, "documents")
    return df.select(*cols) if cols else df


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, as ``--py-files``
    would, once per application: the session may have been started from
    anywhere, and tasks import the package's helpers."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="cumulo-code-")  # read by the driver, which serves it
    archive = f"{folder}/cumulo.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: cuts lineage,
    survives lost executors, and joins on it start from a plain scan (so AQE
    can split hot keys, which it cannot above an aggregate)."""
    # what earlier steps shuffled is written by now: when the JVM finds those
    # plans unreachable, Spark deletes their shuffle files on all executors
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete tables of ``stage`` that nothing reads any more: what was made
    from them is written itself."""
    for df in staged:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def n_words(text: Column) -> Column:
    """Number of words as long; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def free_prefix(columns, wanted: str = "_own") -> str:
    """``wanted``, or with underscores added until no column begins with it."""
    taken = [c.lower() for c in columns]
    while any(c.startswith(wanted.lower()) for c in taken):
        wanted = "_" + wanted
    return wanted


def free_name(columns, wanted: str) -> str:
    """``wanted``, or with underscores added until no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
