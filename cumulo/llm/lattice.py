"""Embedding near-dedup by E8 lattice hashing.

A table projects the unit vectors onto ``BLOCKS`` random 8-dimensional
subspaces and decodes each projection to the nearest point of the E8 lattice;
the points together name a cell.  Every vector is stored in its own cell of
every table and probes the neighbouring lattice cells nearest to it.  Vectors
that meet are candidates; their cosine is checked in double precision.  Equal
vectors are one class throughout, so a vector that a third of all rows share
is stored and compared once.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.llm import textbuf as tb
from cumulo.llm.common import stage
from cumulo.llm.components import components

#: Tables, 8-dimensional blocks of a table, neighbouring cells probed per
#: block, and length of a lattice unit.  Found by recall on pairs at the
#: threshold: vectors of cosine 0.93 meet in at least one table in over 0.95
#: of all cases, whatever their number (README).
TABLES, BLOCKS, PROBES, UNIT = 6, 2, 2, 1.8


def nearest_d8(y: np.ndarray) -> np.ndarray:
    """The nearest integer point of even coordinate sum: round, and where the
    sum is odd round the worst coordinate the other way."""
    near = np.rint(y)
    off = y - near
    worst = np.abs(off).argmax(axis=1)
    rows = np.arange(len(y))
    flip = np.where(off[rows, worst] >= 0, 1.0, -1.0) * (near.sum(axis=1) % 2 != 0)
    near[rows, worst] += flip
    return near


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 shifted by one half everywhere: the nearer of the two."""
    whole, half = nearest_d8(y), nearest_d8(y - 0.5) + 0.5
    take = ((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1)
    return np.where(take[:, None], whole, half)


def shortest_vectors() -> np.ndarray:
    """The 240 lattice vectors of least length: steps to neighbouring cells."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def cells(unit: np.ndarray, label: np.ndarray, probe: bool) -> np.ndarray:
    """Rows x keys: the own cell in each table, or also the neighbouring ones."""
    n, dim = unit.shape
    rng = np.random.default_rng(29)
    steps = shortest_vectors()
    keys = []
    for table in range(TABLES):
        parts = []  # per block: rows x choices of hashed lattice points
        for block in range(BLOCKS):
            y = unit @ rng.normal(0, 1 / UNIT, (dim, 8))
            point = nearest_e8(y)
            points = point[:, None, :]
            if probe:
                closest = np.argpartition(-(y - point) @ steps.T, PROBES, axis=1)[:, :PROBES]
                points = np.concatenate([points, point[:, None, :] + steps[closest]], axis=1)
            odd = rng.integers(1, 2**62, 8, dtype=np.int64) * 2 + 1
            parts.append(((2 * points).astype(np.int64) * odd).sum(axis=2).astype(np.uint64))
        key = np.full((n, 1), table, np.uint64) + label[:, None].astype(np.uint64) * tb.U64(0x9E3779B97F4A7C15)
        for part in parts:
            key = tb.mix((key[:, :, None] * tb.U64(0xC2B2AE3D27D4EB4F) + part[:, None, :]).reshape(n, -1))
        keys.append(key)
    return np.concatenate(keys, axis=1).view(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square over- or underflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cell_rows(classes: DataFrame, probe: bool) -> DataFrame:
    """(``cell``, ``id``) of every class: where it is stored, or looks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                dims = np.asarray(pa.compute.list_value_length(part.column(2)))
                for dim in np.unique(dims):  # vectors of other lengths never meet
                    rows = part.take(pa.array(np.flatnonzero(dims == dim)))
                    keys = cells(_unit(_matrix(rows.column(2))), np.asarray(rows.column(1)).astype(np.int64) * 4096 + dim, probe)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.ravel()), pa.array(np.repeat(np.asarray(rows.column(0)), keys.shape[1]))],
                        names=["cell", "id"])

    return classes.select("id", "label", "vector").mapInArrow(run, "cell long, id long")


def checked(pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (``a``, ``b``, ``va``, ``vb``) whose cosine reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lengths = [np.asarray(pa.compute.list_value_length(batch.column(i))) for i in (2, 3)]
                batch = batch.filter(pa.array(lengths[0] == lengths[1]))
                dims = lengths[0][lengths[0] == lengths[1]]
                for dim in np.unique(dims):
                    part = batch.filter(pa.array(dims == dim))
                    near = (_unit(_matrix(part.column(2))) * _unit(_matrix(part.column(3)))).sum(axis=1) >= threshold
                    yield pa.RecordBatch.from_arrays([c.filter(pa.array(near)) for c in part.columns[:2]], names=["a", "b"])

    return pairs.select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: ``id_col``, ``n_links``, ``component_id``, ``kept``.

    Vectors link within one label when their cosine is at least ``threshold``
    and they meet in some table.  Null, empty and zero vectors, vectors with a
    null or non-finite component, and rows with a null label or id link with
    nothing: no links, their own component (null for a null id, which is not
    kept).  Repeated rows count as vectors of their own that link to each
    other.  An empty table gives an empty result.
    """
    values = F.col("vector")
    usable = (F.col("id").isNotNull() & F.col("label").isNotNull() & values.isNotNull()
              & F.forall(values, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
              & F.exists(values, lambda x: F.coalesce(x != 0, F.lit(False))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.withColumn("vector", F.when(usable, values))
    grouped = stage(rows.filter("vector is not null").groupBy("label", "vector")
                    .agg(F.min("id").alias("id"), F.count("*").alias("n")), "vector-classes")
    # an id may name different vectors: classes get a number of their own
    own = grouped.withColumn("class", F.xxhash64("label", "vector"))
    classes = stage(own.select("class", "label", "vector", "id", "n"), "classes")
    by_class = classes.select(F.col("class").alias("id"), "label", "vector")
    met = (cell_rows(by_class, probe=True).withColumnRenamed("id", "x")
           .join(cell_rows(by_class, probe=False).withColumnRenamed("id", "y"), "cell").filter("x <> y")
           .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    vec = classes.select("class", "vector")
    pairs = (met.join(vec.select(F.col("class").alias("a"), F.col("vector").alias("va")), "a")
             .join(vec.select(F.col("class").alias("b"), F.col("vector").alias("vb")), "b"))
    links = stage(checked(pairs, threshold), "vector-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    size = classes.select(F.col("class").alias("b"), "n")
    degree = both.join(size, "b").groupBy("a").agg(F.sum("n").alias("others")).withColumnRenamed("a", "class")
    root = components(links).select(F.col("node").alias("class"), "root")
    of_class = (classes.join(degree, "class", "left").join(root, "class", "left")
                .withColumn("root", F.coalesce("root", "class")))
    least = of_class.groupBy("root").agg(F.min("id").alias("component_id"))
    of_class = stage(of_class.join(least, "root").select(
        F.col("label").alias("_label"), F.col("vector").alias("_vector"), "component_id",
        (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "class-verdicts")
    found = rows.filter("vector is not null").join(
        of_class, (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")))
    alone = rows.filter("vector is null").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return (found.select("id", "n_links", "component_id").unionByName(alone)
            .select(F.col("id").alias(id_col), "n_links", "component_id",
                    F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")))
