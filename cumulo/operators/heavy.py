"""Exact top-k by count over keys of high cardinality.

A plain ``groupBy(key).count()`` shuffles every key.  Here each task keeps a
bounded summary of its frequent keys (Misra-Gries counters): a key's counter is
at most ``error`` below its count in the task, where ``error`` is known.  Added
up, the summaries bound every key's count from both sides, so the keys that can
be among the first k are known, and only they are counted exactly.  What is
shuffled is summaries and the candidates' counts, whatever the number of keys.

When keys are so even that the bounds decide nothing (a key outside every
summary might still be among the first k), all keys are counted: the exact way
for the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cumulo.sources.session import checkpoint_root

#: Counters of a task's summary.
COUNTERS = 10_000


class Summary:
    """Misra-Gries counters: ``counts[key] <= count <= counts[key] + error``."""

    def __init__(self, size: int):
        self.size, self.counts, self.error = size, {}, 0

    def add(self, keys: list, counts: list[int]) -> None:
        """Add distinct keys with their counts."""
        held = self.counts
        for key, n in zip(keys, counts):
            held[key] = held.get(key, 0) + n
        if len(held) > self.size:
            values = np.fromiter(held.values(), np.int64, len(held))
            cut = int(np.partition(values, len(values) - self.size - 1)[len(values) - self.size - 1])
            self.counts = {k: n - cut for k, n in held.items() if n > cut}
            self.error += cut


def summaries(df: DataFrame, key: str, counters: int = COUNTERS) -> DataFrame:
    """(``key``, ``least``, ``error``): rows of all tasks' summaries, and one row
    per task with a null ``least``, which has the task's ``error``."""
    rows = df.select(F.col(key).alias("key")).where("key is not null")
    schema = StructType([StructField("key", rows.schema["key"].dataType), StructField("least", LongType()), StructField("error", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, kind = Summary(counters), None
        for batch in batches:
            column = batch.column(0)
            kind = column.type
            many = column.value_counts()
            found.add(many.field(0).to_pylist(), many.field(1).to_pylist())
        if kind is not None:
            n = len(found.counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*found.counts, None], kind), pa.array([*found.counts.values(), None], pa.int64()),
                 pa.array([None] * n + [found.error], pa.int64())], names=["key", "least", "error"])

    return rows.mapInArrow(run, schema)


def top_counts(df: DataFrame, key: str, k: int = 1, counters: int = COUNTERS, out_col: str = "n") -> DataFrame:
    """The ``k`` keys with most rows (``key``, ``out_col``): exact, ties to the
    least key, null keys left out."""
    checkpoint_root(df.sparkSession)
    bounds = summaries(df, key, counters).groupBy("key").agg(F.sum("least").alias("least"), F.sum("error").alias("error")).checkpoint()
    error = bounds.agg(F.sum("error")).first()[0] or 0  # one number
    first = [r["least"] for r in bounds.where("least is not null").orderBy(F.desc("least")).limit(k).collect()]  # k numbers
    bar = first[-1] if len(first) == k else 0
    if error >= bar > 0 or (bar == 0 and error > 0):  # a key that no summary holds may be among the first
        counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out_col))
    else:
        # every key that can reach the k-th; others can't, whatever the summaries missed
        able = bounds.where(F.col("least") + F.lit(error) >= bar).where("least is not null").select(F.col("key").alias(key))
        counted = df.join(able, key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias(out_col))
    return counted.orderBy(F.desc(out_col), F.asc(key)).limit(k)
