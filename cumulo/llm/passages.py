"""Substring dedup with repeated-phrase automata.

1. Confirm recurring passages.  Every window of ``WINDOW`` words has an anchor,
   its shingle of least hash, which equal windows share.  Anchors that only
   one text has rule their windows out; the remaining windows, merged to runs,
   are compared by fingerprint, which gives the first document of each
   recurring window.  Equal texts are one, with their smallest document.
2. Compile sharded automata.  Runs fall into blocks of bounded size.
   The recurring windows of a block, merged to passages of their first
   documents, are cut into phrases of seven words, one at every seventh word,
   so that any window of a passage has a whole phrase; pyahocorasick compiles
   one automaton per block over word numbers.
3. Stream the documents' runs of a block through its automaton.  At each
   occurrence of a phrase passage and document are compared word by word as far
   as a window reaches; agreements of a whole window are located copies.

Fingerprints only choose what is compared; every reported word has been
matched word by word.  What many documents share is aggregated map-side, and
reaches every block once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.llm import textbuf as tb
from cumulo.llm.common import stage

WINDOW, ANCHOR, PHRASE = 13, 5, 7
#: Words of a window on either side of its phrase.
REACH = WINDOW - PHRASE
#: Words of candidate runs per block (one automaton each).
BLOCK_WORDS = 100_000
LAST = 2**63 - 1

_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def anchors(texts: pa.Array):
    """Words of a batch and their windows: (words, window starts, each
    window's anchor position, anchor hashes by position)."""
    data, offs = tb.buffer(texts)
    found = tb.words(data, offs)
    s, e, doc = found
    shingle = tb.window_hash(tb.Rolling(data).of(s, e), ANCHOR)
    start = tb.window_starts(doc, WINDOW)
    at = tb.run_minima(shingle, WINDOW - ANCHOR + 1)[start] if len(start) else start
    return data, offs, found, start, at, shingle


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(``anchor``, ``tid``) once per text and anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, 1):
                _, _, (_, _, doc), _, at, shingle = anchors(part.column(1))
                at = at[tb.runs_of(at)]  # anchors don't go back
                owner, key = doc[at], shingle[at]
                order = np.lexsort((key, owner))
                owner, key = owner[order], key[order]
                new = tb.runs_of(owner, key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[new].view(np.int64)), part.column(0).take(pa.array(owner[new]))], names=["anchor", "tid"])
        tb.release()

    return docs.select("tid", "text").mapInArrow(run, "anchor long, tid long")


def candidate_runs(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(``tid``, ``key``, ``rank``, ``start``, ``n``, ``run``): maximal runs of
    windows whose anchors occur in two texts, from the first document of each
    text; ``start`` counts words."""
    rows = anchor_rows(docs)
    recurring = stage(rows.groupBy("anchor").agg(F.min("tid").alias("low"), F.max("tid").alias("high"))
                      .filter("low < high").select("anchor"), "recurring-anchors")
    per_text = stage(rows.join(recurring.hint("merge"), "anchor")
                     .groupBy("tid").agg(F.collect_set("anchor").alias("anchors")), "text-anchors")
    wanted = stage(firsts.join(per_text, "tid"), "texts-with-anchors").withColumnRenamed("first", "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, 3):
                data, _, (s, e, doc), start, at, shingle = anchors(part.column(3))
                lists = part.column(4)
                owner = np.repeat(np.arange(part.num_rows, dtype=np.uint64), np.asarray(pa.compute.list_value_length(lists)))
                known = tb.mix(np.asarray(lists.flatten()).view(np.uint64) + owner)
                start = start[np.isin(tb.mix(shingle[at] + doc[start].astype(np.uint64)), known)]
                first = tb.runs_of(start - np.arange(len(start)), doc[start])
                begin = start[first]
                end = start[np.append(first[1:], len(start)) - 1] + WINDOW - 1 if len(first) else begin
                owner = pa.array(doc[begin])
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i).take(owner) for i in range(3)],
                     pa.array((begin - np.searchsorted(doc, doc[begin])).astype(np.int32)),  # from the text's first word
                     pa.array((end - begin + 1).astype(np.int32)),
                     pa.array([bytes(data[a:b]).decode() for a, b in zip(s[begin], e[end])], pa.string())],
                    names=["tid", "key", "rank", "start", "n", "run"])
        tb.release()

    # a text's first document may be a repeated row: one of them
    return (docs.join(wanted.hint("merge"), ["tid", "key", "rank"]).dropDuplicates(["tid", "key"])
            .select("tid", "key", "rank", "text", "anchors")
            .mapInArrow(run, "tid long, key string, rank long, start int, n int, run string"))


def window_rows(runs: DataFrame, blocks: int) -> DataFrame:
    """One row per window of a run: fingerprint (96 bits), place, block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, 2):
                data, offs = tb.buffer(part.column(2))
                s, e, doc = tb.words(data, offs)
                at = tb.window_starts(doc, WINDOW)
                w1 = tb.window_hash(tb.Rolling(data).of(s, e), WINDOW)[at].view(np.int64)
                w2 = tb.window_hash(tb.Rolling(data, 12).of(s, e), WINDOW)[at].view(np.int64) >> 32
                owner = pa.array(doc[at])
                number = part.column(1).take(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1), pa.array(w2.astype(np.int32)), part.column(0).take(owner), number,
                     pa.array((at - np.searchsorted(doc, doc[at])).astype(np.int32)),
                     pa.array((np.asarray(number) % blocks).astype(np.int32))],
                    names=["w1", "w2", "rank", "number", "pos", "block"])
        tb.release()

    return runs.select("rank", "number", "run").mapInArrow(
        run, "w1 long, w2 int, rank long, number long, pos int, block int")


def block_passages(runs: DataFrame, blocks: int) -> DataFrame:
    """(``block``, ``first_rank``, ``passage``): for every block the recurring
    windows it needs, merged to passages of their first documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, rank, passage = [], [], []
            for b, r, text, at in zip(*(batch.column(i).to_pylist() for i in range(4))):
                words, at = _WORDS(text), sorted(set(at))
                begin = at[0]
                for here, after in zip(at, [*at[1:], None]):
                    if after is None or after > here + 1:  # a maximal passage
                        block.append(b)
                        rank.append(r)
                        passage.append(" ".join(words[begin:here + WINDOW]))
                        begin = after
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(rank, pa.int64()), pa.array(passage, pa.string())],
                                             names=["block", "first_rank", "passage"])
        tb.release()

    places = (window_rows(runs, blocks).groupBy("w1", "w2")
              .agg(F.min(F.struct("rank", "number", "pos")).alias("first"), F.max("rank").alias("last"),
                   F.collect_set("block").alias("blocks"))  # at most one entry per block
              .filter("first.rank < last").select("first.number", "first.pos", F.explode("blocks").alias("block"))
              .groupBy("number", "block").agg(F.collect_list("pos").alias("at")))
    # a run is cut where it is read: only passages go on to the blocks
    return stage(places, "passages").hint("merge").join(runs.select("number", "rank", "run"), "number").select(
        "block", "rank", "run", "at").mapInArrow(run, "block int, first_rank long, passage string")


def _phrases(passages: pa.Table):
    """Automaton over word numbers, and the word numbers.  A phrase knows the
    places it has in passages by what stands there up to a window's reach to
    the left and right, and the smallest rank of each: in text that repeats
    itself most places look alike and are one."""
    number: dict[str, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    entries: dict[tuple[int, ...], dict] = {}
    for rank, text in zip(*(passages.column(c).to_pylist() for c in ("first_rank", "passage"))):
        ids = tuple([number.setdefault(w, len(number) + 1) for w in text.split(" ")])
        for o in range(0, len(ids) - PHRASE + 1, PHRASE):
            places = entries.setdefault(ids[o:o + PHRASE], {})
            around = ids[max(0, o - REACH):o], ids[o + PHRASE:o + PHRASE + REACH]
            places[around] = min(rank, places.get(around, LAST))
    for phrase, places in entries.items():
        automaton.add_word(phrase, places)
    if entries:
        automaton.make_automaton()
    return automaton if entries else None, number


def _agree(a, b) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def locate(block_runs: pa.Table, passages: pa.Table) -> pa.Table:
    """Word spans (``number``, ``begin``, ``end``) of the block's runs that a
    document of smaller rank has too.

    At a hit the words around the phrase are compared as far as a window
    reaches, which locates the windows that hold the phrase; any window of a
    passage holds a whole phrase.
    """
    automaton, number = _phrases(passages)
    out: list[tuple[int, int, int]] = []
    for which, rank, text in zip(*(block_runs.column(c).to_pylist() for c in ("number", "rank", "run"))):
        if automaton is None:
            break
        ids = tuple([number.get(w, 0) for w in _WORDS(text)])
        last = len(ids) - WINDOW
        located = bytearray(max(last + 1, 0))  # by the window's start
        for end, places in automaton.iter(ids):
            at = end - PHRASE + 1
            first, stop = max(0, at - REACH), min(at, last) + 1  # the windows that hold the phrase
            if located.find(0, first, stop) < 0:
                continue
            left, right = ids[first:at], ids[end + 1:end + 1 + REACH]
            if places.get((left, right), LAST) < rank:
                located[first:stop] = b"\1" * (stop - first)
                continue
            for (before, after), other in places.items():
                if other < rank:
                    low = at - _agree(left[::-1], before[::-1])
                    high = at + PHRASE + _agree(right, after) - WINDOW + 1
                    if high > low:
                        located[low:high] = b"\1" * (high - low)
                        if located.find(0, first, stop) < 0:
                            break
        begin = located.find(1)
        while begin >= 0:
            end = located.find(0, begin)
            end = len(located) if end < 0 else end
            out.append((which, begin, end + WINDOW - 1))
            begin = located.find(1, end)
    columns = list(zip(*out)) if out else [(), (), ()]
    del automaton, number
    tb.release()
    return pa.table({"number": pa.array(columns[0], pa.int64()), "begin": pa.array(columns[1], pa.int32()),
                     "end": pa.array(columns[2], pa.int32())})


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents with an order (null ids last), a short and a full text key."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), text.alias("text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("rank"),
                       F.xxhash64(text).alias("tid"), F.md5(text).alias("key"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``tid``, ``key``, ``first``, ``spans``) per text: its smallest document
    id, and the word ranges of windows that start in a smaller one too (null:
    none).  All words of a text's other documents are in such windows, if it
    has a window at all."""
    named = _named(docs, id_col, text_col)
    firsts = stage(named.groupBy("tid", "key").agg(F.min("rank").alias("first")), "first-documents")
    runs = stage(candidate_runs(named.select("tid", "key", "rank", "text"), firsts)
                 .withColumn("number", F.monotonically_increasing_id()), "candidate-runs")
    total = runs.agg(F.sum("n")).first()[0] or 0
    blocks = int(total // BLOCK_WORDS) + 1
    keyed = runs.select(F.pmod("number", F.lit(blocks)).cast("int").alias("block"), "number", "rank", "run")
    found = stage(keyed.groupBy("block").cogroup(block_passages(runs, blocks).groupBy("block")).applyInArrow(
        locate, "number long, begin int, end int").distinct(), "spans")
    spans = (found.join(runs.select("number", "tid", "key", "start"), "number")
             .groupBy("tid", "key").agg(F.collect_set(F.struct(
                 (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("end")).alias("end"))).alias("spans")))
    return stage(firsts.join(spans, ["tid", "key"], "left"), "text-spans")


def _removed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``row``, ``n_words``, ``n_removed``, ``kept_text``)."""
    spans = repeated_spans(docs, id_col, text_col)
    joined = (_named(docs, id_col, text_col).drop("text").join(spans.hint("merge"), ["tid", "key"])
              .select("row", F.coalesce(F.col("row")[text_col], F.lit("")).alias("text"), F.col("spans.begin").alias("begin"),
                      F.col("spans.end").alias("end"), (F.col("rank") > F.col("first")).alias("copy")))
    schema = joined.select("row").schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, removed, kept = [], [], []
            for text, begin, end, copy in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4))):
                found = _WORDS(text)
                words.append(len(found))
                if copy and len(found) >= WINDOW:
                    begin, end = [0], [len(found)]
                for b, e in zip(begin or (), end or ()):
                    found[b:e] = [None] * (e - b)
                found = [w for w in found if w is not None]
                removed.append(words[-1] - len(found))
                kept.append(" ".join(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["row", "n_words", "n_removed", "kept_text"])
        tb.release()

    return joined.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (in place of
    input columns of these names): the words of each whole text without those
    covered by a window of 13 words that also starts in a document with a
    smaller id, joined by one space.

    Null and empty texts have no words.  Null ids come after all others and
    are equal to each other; rows with equal ids don't remove each other's
    words.  An empty table gives an empty result.
    """
    new = ("n_words", "n_removed", "kept_text")
    return _removed(docs, id_col, text_col).select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c not in new], *new)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns: texts that lose words are replaced by
    their kept words joined by one space, the others stay as they are."""
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row")[text_col])
    return _removed(docs, id_col, text_col).select(
        *[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
