"""Corpus pipeline over ``documents``: quality rules, near-duplicates,
repeated passages, mixing, tokens.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all rows
its predecessor kept; all but the last return the columns of ``documents``.
Rows may be repeated, have null or empty texts, or be missing altogether: the
rules reject texts without words, the near-duplicate stage keeps one row of
each group, and an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.llm import bpe, hostrules, icws, mixing, passages
from cumulo.llm.common import documents, ship_code, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host passes."""
    ship_code(spark)
    return hostrules.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id."""
    ship_code(spark)
    return icws.deduplicated(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has."""
    ship_code(spark)
    return passages.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mix: sources repeated or cut to their target weights."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row of the mix, encoded and decoded."""
    ship_code(spark)
    done = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("passage dedup", passage_dedup),
    ("mixing", source_mix),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs


#: Near-duplicate links and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None
