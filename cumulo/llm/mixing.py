"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key.  The key's leading hex digits name a
range; keys are uniform, so the ranges of one source hold equally many
documents however large the source is, and sorting inside (source, range)
sorts the whole source without a sampling pass and without one task per
source.  Prefix sums of token counts come in two steps: totals per (source,
range) give each range's offset, a running sum inside the range gives the
rest.  The cut at the source's exact budget is then a row-wise expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cumulo.llm.common import WORD, free_prefix, n_words

#: Hex digits of the range number: 16**3 ranges per source.
RANGE_DIGITS = 3


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
                   max_epochs: float = 2.0) -> DataFrame:
    """Token targets per source from (``_src``, ``_src_size``).

    Sources by code point, null last, take ``weights`` in turn and share
    ``share`` times all tokens; a target stops at ``max_epochs`` times its
    source, the excess is shared again by weight until none is above.  That
    fixed point is a water level: with the sources sorted by cap / weight, a
    source is capped if its cap is at most the level that is left when all
    before it are capped.  Works on one row per source.
    """
    table = sizes.select(
        "*",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                     ((F.row_number().over(Window.orderBy(F.col("_src").asc_nulls_last())) - 1)
                      % len(weights) + 1).cast("int")).alias("_w"),
        (F.col("_src_size") * F.lit(float(max_epochs))).alias("_cap"))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_src").asc_nulls_last())
    everything = Window.partitionBy()
    table = table.select(
        "*",
        ((F.sum("_src_size").over(everything) * F.lit(float(share))
          - F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         / F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))).alias("_level"))
    capped = F.col("_cap") <= F.col("_level") * F.col("_w")
    level = F.max(F.when(~capped, F.col("_level"))).over(everything)
    return table.select("_src", "_src_size",
                        F.when(capped, F.col("_cap")).otherwise(level * F.col("_w")).alias("_target"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
        max_epochs: float = 2.0, seed: str = "mix", id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: how many of its words the mix takes.

    Returns all input columns plus ``mix_size`` (words), ``mix_source_size``,
    ``mix_target``, ``mix_epochs`` (whole repeats) and ``mix_taken``, in place of
    input columns of these names.  Each
    source's taken words sum to exactly floor(target): whole epochs over the
    source, then documents in key order up to the budget; the document at the
    cut is taken in part.

    Null text has size 0 and nothing is taken from it; null sources form one
    source (last); a null id hashes like the empty string.  Repeated rows and
    ties in the key are ordered by id and size, so the multiset of results is
    the same on every run.  An empty table gives an empty result.
    """
    new = ("mix_size", "mix_source_size", "mix_target", "mix_epochs", "mix_taken")
    own = free_prefix(docs.columns)  # input columns may have any name
    size, key, rng, src, before, offset = (f"{own}_{c}" for c in ("size", "key", "range", "source", "before", "offset"))
    kept = [c for c in docs.columns if c.lower() not in new]
    hashed = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    sized = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(id_col).alias(f"{own}_id"), F.col(source_col).alias(src),
                        n_words(F.col(text_col)).alias(size), hashed.alias(key), F.substring(hashed, 1, RANGE_DIGITS).alias(rng))
    ranges = sized.groupBy(F.col(src).alias("_src"), F.col(rng).alias("_rng")).agg(F.sum(size).alias("_n"))
    targets = source_targets(
        ranges.groupBy("_src").agg(F.sum("_n").alias("_src_size")), weights, share, max_epochs)
    upto = Window.partitionBy("_src").orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranges.select("_src", "_rng", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_offset"))
               .withColumnRenamed("_src", "_s")
               .join(targets, F.col("_s").eqNullSafe(F.col("_src"))).drop("_s"))
    offsets = offsets.select(*[F.col(c).alias(f"{offset}{c}") for c in offsets.columns])
    within = (Window.partitionBy(src, rng).orderBy(key, f"{own}_id", size)
              .rowsBetween(Window.unboundedPreceding, -1))
    source_size, target = F.col(f"{offset}_src_size"), F.col(f"{offset}_target")
    budget = F.floor(target).cast("long")
    epochs = F.when(source_size > 0, F.floor(budget / source_size)).otherwise(0).cast("long")
    ahead = F.col(f"{offset}_offset") + F.col(before)
    part = F.least(F.col(size), F.greatest(F.lit(0).cast("long"), budget - epochs * source_size - ahead))
    return (sized.withColumn(before, F.coalesce(F.sum(size).over(within), F.lit(0)))
            .join(offsets, F.col(src).eqNullSafe(F.col(f"{offset}_src")) & (F.col(rng) == F.col(f"{offset}_rng")))
            .select(*[F.col(f"`{c}`") for c in kept], F.col(size).alias("mix_size"),
                    source_size.alias("mix_source_size"), target.alias("mix_target"),
                    epochs.alias("mix_epochs"), (epochs * F.col(size) + part).alias("mix_taken")))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
               text_col: str = "text", **params) -> DataFrame:
    """The mix itself, with the columns of ``docs``: one row per whole repeat
    of a document, and the document at each source's cut with its first words
    (joined by one space).  Documents outside the budget, and those without a
    word, give no row."""
    rows = mix(docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row")), id_col=f"row.`{id_col}`",
               source_col=f"row.`{source_col}`", text_col=f"row.`{text_col}`", **params)
    part = F.col("mix_taken") - F.col("mix_epochs") * F.col("mix_size")
    copies = F.concat(  # words of each row that the document gives
        F.array_repeat(F.col("mix_size"), F.col("mix_epochs").cast("int")),
        F.array_repeat(part, F.when(part > 0, 1).otherwise(0)))
    rows = rows.filter("mix_taken > 0").withColumn("_words", F.explode(copies))
    whole = F.col("row")[text_col]
    words = F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))
    text = (F.when(F.col("_words") < F.col("mix_size"),
                   F.array_join(F.slice(words, F.lit(1), F.col("_words").cast("int")), " "))
            .otherwise(whole))
    return rows.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
