"""Plan inspection and session-setting helpers.

``explain()`` prints; these return data so tests can assert on plans
(number of shuffles, join strategy) the way the notebooks read them.
"""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def physical_plan(df: DataFrame) -> str:
    """Physical plan text.  Under AQE this is the initial plan until this
    DataFrame has run (``collect``), after which it is the final plan."""
    return df._jdf.queryExecution().executedPlan().toString()


def plan_nodes(df: DataFrame) -> list[str]:
    """Operator names of the physical plan, outermost first."""
    out = []
    for line in physical_plan(df).splitlines():
        m = re.match(r"^[\s:+\-*()0-9]*([A-Z][A-Za-z]+)", line)
        if m:
            out.append(m.group(1))
    return out


def exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges (broadcast exchanges not counted)."""
    return sum(1 for n in plan_nodes(df) if n in ("Exchange", "ShuffleExchange"))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (from file sizes and statistics;
    no job is run).  Unknown sizes come back as a very large number."""
    try:
        v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(v) if isinstance(v, int) else int(str(v.toString()))
    except Exception:  # pragma: no cover - defensive: unknown means "large"
        return 1 << 62


def has_join(df: DataFrame) -> bool:
    """Does ``df`` join tables (its size estimate is then a product)?"""
    return " Join " in f" {df._jdf.queryExecution().optimizedPlan().toString()} ".replace("\n", " ")


@contextmanager
def session_conf(spark: SparkSession, **settings):
    """Set SQL confs for a block and restore the previous values after it.

    Keys use ``__`` for dots: ``session_conf(spark, spark__sql__autoBroadcastJoinThreshold=-1)``
    or pass a dict via ``**{"spark.sql.x": v}``.
    """
    saved = {}
    for k, v in settings.items():
        key = k.replace("__", ".")
        saved[key] = spark.conf.get(key, None)
        spark.conf.set(key, str(v))
    try:
        yield spark
    finally:
        for key, v in saved.items():
            if v is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, v)


@contextmanager
def persisted(df: DataFrame, level=None):
    """Persist ``df`` for a block that reads it more than once, then release
    it (``cache()`` / ``unpersist()`` around a reuse).  Default storage is
    memory with spill to disk, so a frame larger than the cache never fails;
    data that must survive the job belongs in a written table instead."""
    from pyspark import StorageLevel

    d = df.persist(level or StorageLevel.MEMORY_AND_DISK)
    try:
        yield d
    finally:
        d.unpersist()
