"""Labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id is in no fold (-1)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(-1))


def known(labels: DataFrame, label_col: str, folds: int, held_out: int) -> DataFrame:
    """All labelled ids (``doc_id``, ``label``) outside the held-out fold.  Null
    ids and labels are left out; of several labels of one id the largest counts."""
    return (labels.select("doc_id", F.col(label_col).cast("int").alias("label"))
            .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull()
                    & (fold(F.col("doc_id"), folds) != held_out))
            .groupBy("doc_id").agg(F.max("label").alias("label")))


def sample(labels: DataFrame, label_col: str, folds: int, held_out: int, rows: int) -> DataFrame:
    """At most ``rows`` of the ``known`` ids, in hash order: the same on every
    run, and the documented bound that allows a broadcast."""
    return known(labels, label_col, folds, held_out).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
