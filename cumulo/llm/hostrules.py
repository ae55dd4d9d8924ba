"""Quality rules per document, and host-level verdicts.

Document counts come from one pass over the texts (numpy on Arrow batches).
Rule failures are summed per host (map-side partial sums, so a host with a
third of all documents is no hot key), each host's failure rate is shrunk
towards the corpus by an empirical beta prior, and the host verdicts are
joined back to the documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulo.llm import textbuf as tb
from cumulo.llm.common import free_name, free_prefix, stage

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True  # fixed by the task


def _repeats(doc: np.ndarray, value: np.ndarray):
    """Masks over rows: (value seen earlier in the document, value found twice or more)."""
    order = np.lexsort((value, doc))
    same = (doc[order][1:] == doc[order][:-1]) & (value[order][1:] == value[order][:-1])
    later, twice = np.zeros(len(doc), bool), np.zeros(len(doc), bool)
    later[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return later, twice


def count_batch(texts: pa.Array) -> dict[str, np.ndarray]:
    """The COUNTS of each text of one batch."""
    data, offs = tb.buffer(texts)
    n = len(offs) - 1
    start, end, doc = tb.words(data, offs)
    rolling = tb.Rolling(data)
    value = rolling.of(start, end)
    per_doc = lambda d, w=None: np.bincount(d, weights=w, minlength=n)[:n].astype(np.int64)
    # code points: bytes that are not UTF-8 continuations
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    # lines with a word: cut at \n and at document ends
    breaks = np.flatnonzero(data == 0x0A)
    cuts = np.unique(np.concatenate([offs, breaks + 1]))
    line_of = np.searchsorted(cuts, start, "right") - 1
    lines = np.unique(line_of)
    line_start = cuts[lines]
    line_end = np.append(cuts, len(data))[lines + 1] if len(lines) else line_start
    if len(lines):  # without the line break itself
        ends_in_break = np.isin(line_end - 1, breaks, assume_unique=True)
        line_end = line_end - ends_in_break
    line_doc = np.searchsorted(offs, line_start, "right") - 1
    line_later, _ = _repeats(line_doc, rolling.of(line_start, line_end))
    # words in 3-word windows found twice or more
    at = tb.window_starts(doc, 3)
    _, twice = _repeats(doc[at], tb.window_hash(value, 3)[at])
    covered = np.zeros(len(start) + 3, bool)
    for j in range(3):
        covered[at[twice] + j] = True
    return {
        "n_words": per_doc(doc),
        "word_chars": per_doc(doc, points[end] - points[start]),
        "n_symbols": (symbols[offs[1:]] - symbols[offs[:-1]]).astype(np.int64),
        "n_dup_lines": per_doc(line_doc[line_later]),
        "n_repeat_words": per_doc(doc[covered[:len(start)]]),
    }


def document_counts(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of ``docs`` plus the COUNTS (longs) of its whole texts.
    Only the texts go to Python, and only the counts come back."""

    @F.arrow_udf(", ".join(f"{c} long" for c in COUNTS))
    def counts(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [count_batch(part.column(0)) for part in tb.slices(batch, 0)] or [count_batch(texts)]
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate([p[c] for p in parts])) for c in COUNTS], names=list(COUNTS))

    own = free_name(keep, "_counts")
    return docs.select(*keep, counts(F.col(text_col)).alias(own)).select(*keep, f"{own}.*")


def base_failed(min_words: int = 50, max_repeat_pct: int = 50) -> Column:
    return ((F.col("n_words") < min_words)
            | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words")))


def rule_failures() -> Column:
    """A document fails if any rule fails: the base rules, symbol-heavy words,
    mostly repeated lines, or words of an odd mean length."""
    words = F.col("n_words")
    return (base_failed() | (F.col("n_symbols") > 0.5 * words) | (2 * F.col("n_dup_lines") > words)
            | (F.col("word_chars") < 2 * words) | (F.col("word_chars") > 20 * words))


def host_verdicts(counted: DataFrame, host_col: str, max_rate: float = 0.5) -> DataFrame:
    """One row per host: documents, failures, shrunk failure rate, ``host_ok``.

    Prior: beta(a, b) fitted by moments to the hosts' raw rates (each host
    counts once).  With m and v the mean and variance of the rates,
    a + b = m (1 - m) / v - 1; where that is not positive or not defined (one
    host, equal rates, rates only 0 and 1) a + b falls back to 1.  A host is
    rejected if its posterior mean (failures + a) / (documents + a + b)
    exceeds ``max_rate``.
    """
    hosts = stage(counted.groupBy(F.col(host_col).alias("_host"))
                  .agg(F.count("*").alias("host_docs"),
                       F.sum(rule_failures().cast("long")).alias("host_failures")), "hosts")
    rate = F.col("host_failures") / F.col("host_docs")
    mean, spread = hosts.agg(F.avg(rate), F.var_pop(rate)).first()  # two numbers
    strength = mean * (1 - mean) / spread - 1 if spread else 0.0
    strength = strength if strength > 0 else 1.0
    shrunk = ((F.col("host_failures") + F.lit((mean or 0.0) * strength))
              / (F.col("host_docs") + F.lit(strength)))
    return hosts.select("_host", "host_docs", "host_failures", shrunk.alias("host_rate"),
                        (shrunk <= max_rate).alias("host_ok"))


def judge(docs: DataFrame, keep: list[str], host_col: str = "source", text_col: str = "text",
          max_rate: float = 0.5, count_once: bool = True) -> DataFrame:
    """``keep`` columns, COUNTS, ``base_failed``, the host's figures and ``kept``.

    Counts are needed for the hosts and for the documents: with ``count_once``
    they are written with the kept columns in between, else (for wide kept
    columns, such as the text itself) texts are counted twice.

    Null or empty text has no words and fails; null hosts form one host;
    repeated rows are judged (and counted) each; an empty table gives an empty
    result.
    """
    clash = [c for c in keep if c in COUNTS or c.startswith("host_") or c in ("base_failed", "kept")]
    if clash:
        raise ValueError(f"columns {clash} of the input clash with results; leave them out of keep")
    own = f"{free_prefix(docs.columns)}_host"
    counted = document_counts(docs.withColumn(own, F.col(host_col)), [*keep, own], text_col)
    if count_once:
        counted = stage(counted, "document-counts")
    hosts = host_verdicts(counted, own, max_rate).withColumnRenamed("_host", f"{own}_verdict")
    failed = base_failed()
    return (counted.join(hosts, F.col(own).eqNullSafe(F.col(f"{own}_verdict")))
            .select(*keep, *COUNTS, failed.alias("base_failed"), "host_docs", "host_failures",
                    "host_rate", (~failed & F.col("host_ok")).alias("kept")))


def passing(docs: DataFrame, host_col: str = "source", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns."""
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    kept = judge(rows, ["row"], f"row.`{host_col}`", f"row.`{text_col}`", count_once=False, **params).filter("kept")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
