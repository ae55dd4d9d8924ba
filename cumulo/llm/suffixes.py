"""Suffix-array dedup of long byte strings by threshold-bounded interval
expansion.

What can repeat is narrowed down first.  Every string of ``LENGTH`` bytes has
an anchor (its ``GRAM``-byte part of least hash), which equal strings share;
strings whose anchor occurs once are unique.  The others are cut into short
regions: consecutive strings with one anchor at nearly the same distance.
All strings of a region share a core, so only regions of equal cores can hold
equal strings.  A core with one region content, found twice, repeats as a
whole.  Cores with several contents are sorted out on the Burrows-Wheeler
transform of their contents: breadth-first backward extension of suffix
intervals, from the empty string on, meets every pair of neighbouring
suffixes at exactly the length of their common prefix, so values come out in
increasing order; it stops at LENGTH, and the pairs not met by then share at
least LENGTH bytes.

Contents of one core go to one task.  Where they are too many (a passage just
too short, in very many surroundings), their regions are cut narrower, down
to single strings, which makes the core longer and the groups smaller.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from cumulo.llm import textbuf as tb
from cumulo.llm.common import stage

LENGTH, GRAM = 400, 64
#: Widths of a region in string starts, the next where a core has over MANY contents.
WIDTHS, MANY = (64, 8, 1), 1500
#: Bytes of contents per transform.
SHARD_BYTES = 1_000_000
#: Bytes of text worked on at once in a task.
SLICE_BYTES = 1_000_000
LAST = 2**63 - 1
_SPANS = ArrayType(StructType().add("begin", IntegerType()).add("end", IntegerType()))


# --- the transform ----------------------------------------------------------


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; symbols are non-negative."""
    n = len(symbols)
    span = int(symbols.max()) + 2 if n else 2
    step = 1
    key = symbols + 1
    while span ** (step + 1) < 2**62:  # as many symbols as fit into one number
        key = key * span
        key[:max(0, n - step)] += symbols[step:] + 1
        step += 1
    while True:
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[False, key[1:] != key[:-1]][:n])
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        key = rank * (n + 1)
        key[:max(0, n - step)] += rank[step:] + 1
        step *= 2


def shared_prefixes(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Mask over 0..n: entry i tells whether the suffixes ``order[i-1]`` and
    ``order[i]`` share ``length`` symbols or more.

    Entry i is met when the interval of a string ends at i; strings are
    extended backwards by one symbol a round, all of a length at once.
    """
    n = len(symbols)
    span = int(symbols.max()) + 1 if n else 1
    transform = symbols[order - 1]  # the symbol before each suffix, cyclic
    small = np.uint16 if span <= 1 << 16 else np.int64  # sorted by radix if it can be
    back = np.argsort(transform.astype(small), kind="stable")
    step = np.empty(n, np.int64)  # where the suffix one symbol longer stands
    step[back] = np.arange(n)
    unmet = np.ones(n + 1, bool)
    unmet[[0, n]] = False
    begin, end = np.array([0]), np.array([n])
    for _ in range(length):
        if not len(begin):
            break
        single = end - begin == 1
        low = step[begin[single]]
        low = low[unmet[low + 1]]
        found = [(low, low + 1)]
        begin, end = begin[~single], end[~single]
        if len(begin):  # per interval and preceding symbol: first and last place
            sizes = end - begin
            owner = np.repeat(np.arange(len(begin)), sizes)
            place = np.arange(len(owner)) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
            key = owner * span + transform[place]
            if len(begin) * span * n < 2**62:  # sort symbol and place as one number
                key = np.sort(key * n + place)
                place = key % n
                key //= n
            else:
                by = np.argsort(key, kind="stable")
                key, place = key[by], place[by]
            edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            last = step[place[np.append(edge[1:], len(key)) - 1]] + 1
            new = unmet[last]
            found.append((step[place[edge[new]]], last[new]))
        begin = np.concatenate([f[0] for f in found])
        end = np.concatenate([f[1] for f in found])
        unmet[end] = False
    return unmet


def repeated_starts(contents: list[bytes], length: int) -> list[np.ndarray]:
    """For each content the mask of starts whose string of ``length`` bytes
    occurs at another place in any of the contents."""
    sizes = np.array([len(c) for c in contents])
    data = np.frombuffer(b"".join(contents), np.uint8).astype(np.int64)
    ends = np.cumsum(sizes)
    symbols = np.insert(data, ends, 256 + np.arange(len(contents)))  # every end is a symbol of its own
    order = suffix_array(symbols)
    shares = shared_prefixes(symbols, order, length)
    mark = np.zeros(len(symbols) + 1, bool)
    at = np.flatnonzero(shares)
    mark[order[at]] = True
    mark[order[at - 1]] = True
    begin = ends - sizes + np.arange(len(contents))
    return [mark[b:b + max(0, s - length + 1)] for b, s in zip(begin, sizes)]


# --- regions ----------------------------------------------------------------


def _anchors(texts: pa.Array):
    """(bytes, offsets, prefix sums, string starts, their documents, anchor
    of each, gram hashes); anchors don't go back as starts go on."""
    data, offs = tb.buffer(texts)
    counts = np.maximum(np.diff(offs) - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    rolling = tb.Rolling(data)
    if not len(owner):
        return data, offs, rolling, owner, owner, owner, owner
    start = np.arange(len(owner)) + np.repeat(offs[:-1] - (np.cumsum(counts) - counts), counts)
    at = np.arange(len(data) - GRAM + 1)
    gram = rolling.of(at, at + GRAM)
    return data, offs, rolling, start, owner, tb.run_minima(gram, LENGTH - GRAM + 1)[start], gram


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(``anchor``, ``rid``, ``n``): how often an anchor occurs in a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, 1, SLICE_BYTES):
                _, _, _, _, owner, at, gram = _anchors(part.column(1))
                place = tb.runs_of(at)
                key, owner = gram[at[place]].view(np.int64), owner[place]
                order = np.lexsort((key, owner))
                key, owner = key[order], owner[order]
                edge = tb.runs_of(key, owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[edge]), part.column(0).take(pa.array(owner[edge])), pa.array(np.diff(np.append(edge, len(key))))],
                    names=["anchor", "rid", "n"])
        tb.release()

    return docs.select("rid", "text").mapInArrow(run, "anchor long, rid long, n long")


def _cut(rolling, data: np.ndarray, start: np.ndarray, anchor: np.ndarray, seed: np.ndarray, width: int):
    """Regions of string starts: (first start, starts, anchor's distance,
    core's hash, two hashes of the content, whether it's the first of its content)."""
    part = (anchor - start) // width
    edge = tb.runs_of(start - np.arange(len(start)), anchor, part)
    begin, count = start[edge], np.diff(np.append(edge, len(start)))
    away = anchor[edge] - begin
    part = part[edge]
    core = anchor[edge] - part * width  # the last start such a region may have
    key = tb.mix(rolling.of(core, core + LENGTH - width + 1) + seed[edge] * tb.U64(3) + part.astype(np.uint64))
    h1, h2 = (r.of(begin, begin + count + LENGTH - 1) for r in (rolling, tb.Rolling(data, 12)))
    fresh = np.zeros(len(key), bool)
    fresh[np.unique(tb.mix(key + tb.mix(h1 + tb.mix(h2))), return_index=True)[1]] = True
    return begin, count, away, key, h1, h2, fresh


_REGION = "rid long, begin int, count int, away int, key long, h1 long, h2 long, content binary"


def _region_batch(rid: pa.Array, data, base, cut) -> pa.RecordBatch:
    begin, count, away, key, h1, h2, fresh = cut
    content = [bytes(data[b:b + c + LENGTH - 1]) if f else None for b, c, f in zip(begin, count, fresh)]
    return pa.RecordBatch.from_arrays(
        [rid, pa.array((begin - base).astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(away.astype(np.int32)),
         *[pa.array(x.view(np.int64)) for x in (key, h1, h2)], pa.array(content, pa.binary())],
        names=["rid", "begin", "count", "away", "key", "h1", "h2", "content"])


def regions(docs: DataFrame) -> DataFrame:
    """Regions of strings whose anchor occurs twice or more; a content's bytes
    come with its first region of a batch."""
    rows = anchor_rows(docs)
    again = stage(rows.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"), "recurring-grams")
    lists = stage(rows.select("rid", "anchor").join(again, "anchor")
                  .groupBy("rid").agg(F.collect_set("anchor").alias("anchors")), "document-grams")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, 1, SLICE_BYTES):
                data, offs, rolling, start, owner, at, gram = _anchors(part.column(1))
                wanted = part.column(2)
                whose = np.repeat(np.arange(part.num_rows, dtype=np.uint64), np.asarray(pa.compute.list_value_length(wanted)))
                known = tb.mix(np.asarray(wanted.flatten()).view(np.uint64) + whose * tb.U64(7))
                place = tb.runs_of(at)
                hit = np.isin(tb.mix(gram[at[place]] + owner[place].astype(np.uint64) * tb.U64(7)), known)
                hit = np.repeat(hit, np.diff(np.append(place, len(at))))
                if hit.any():
                    at = at[hit]
                    cut = _cut(rolling, data, start[hit], at, gram[at], WIDTHS[0])
                    mine = np.searchsorted(offs, cut[0], "right") - 1
                    yield _region_batch(part.column(0).take(pa.array(mine)), data, offs[mine], cut)
        tb.release()

    # lists grow with the input: merged at any size, never broadcast
    return docs.select("rid", "text").join(lists.hint("merge"), "rid").select("rid", "text", "anchors").mapInArrow(run, _REGION)


def _narrower(found: DataFrame, width: int) -> DataFrame:
    """The same strings in regions of at most ``width`` starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                data, offs = tb.buffer(part.column("content"))
                count, away = (np.asarray(part.column(c)).astype(np.int64) for c in ("count", "away"))
                row = np.repeat(np.arange(part.num_rows), count)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                seed = np.asarray(part.column("key")).view(np.uint64)[row]
                cut = _cut(tb.Rolling(data), data, offs[row] + nth, offs[row] + away[row], seed, width)
                mine = np.searchsorted(offs, cut[0], "right") - 1
                base = offs[mine] - np.asarray(part.column("begin"))[mine]
                yield _region_batch(part.column("rid").take(pa.array(mine)), data, base, cut)

    return found.select("rid", "begin", "count", "away", "key", "h1", "h2", "content").mapInArrow(run, _REGION)


def _sorted_out(shard: pa.Table) -> pa.Table:
    """(``key``, ``h1``, ``h2``, ``low``, ``high``): ranges of starts of each
    content whose strings occur again."""
    content = shard.column("content").to_pylist()
    marks = repeated_starts(content, LENGTH)
    rows, low, high = [], [], []
    for i, (mark, twice) in enumerate(zip(marks, shard.column("twice").to_pylist())):
        if twice:
            mark = np.ones(len(mark), bool)
        flips = np.flatnonzero(np.diff(np.r_[False, mark, False]))
        rows += [i] * (len(flips) // 2)
        low += flips[::2].tolist()
        high += flips[1::2].tolist()
    at = pa.array(rows, pa.int64())
    del marks
    tb.release()
    return pa.table({**{c: shard.column(c).take(at) for c in ("key", "h1", "h2")},
                     "low": pa.array(low, pa.int32()), "high": pa.array(high, pa.int32())})


def _spans(found: DataFrame, widths: tuple[int, ...]) -> DataFrame:
    """(``rid``, ``begin``, ``end``): byte ranges covered by repeated strings."""
    contents = stage(found.groupBy("key", "h1", "h2").agg(F.count("*").alias("n")), "contents")
    cores = stage(contents.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).filter("n > 1"), "cores")
    end = F.lit(LENGTH - 1)
    whole = (found.select("rid", "begin", "count", "key").join(cores.filter("kinds = 1").select("key"), "key")
             .select("rid", "begin", (F.col("begin") + F.col("count") + end).alias("end")))
    several = found.join(cores.filter((F.col("kinds") > 1) & (F.col("kinds") <= MANY)).select("key"), "key")
    several = stage(several.filter("content is not null").dropDuplicates(["key", "h1", "h2"]).select("key", "h1", "h2", "content")
                    .join(contents.select("key", "h1", "h2", (F.col("n") > 1).alias("twice")), ["key", "h1", "h2"]), "several")
    total = several.agg(F.sum(F.length("content"))).first()[0] or 0
    shards = int(total // SHARD_BYTES) + 1
    ranges = stage(several.groupBy(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")).applyInArrow(
        _sorted_out, "key long, h1 long, h2 long, low int, high int"), "ranges")
    partly = (found.select("rid", "begin", "key", "h1", "h2").join(ranges, ["key", "h1", "h2"])
              .select("rid", (F.col("begin") + F.col("low")).alias("begin"), (F.col("begin") + F.col("high") + end).alias("end")))
    spans = whole.unionByName(partly)
    hot = cores.filter(F.col("kinds") > MANY).select("key")
    if len(widths) > 1 and not hot.isEmpty():
        many = found.join(hot, "key")
        bytes_of = (many.filter("content is not null").dropDuplicates(["key", "h1", "h2"]).select("key", "h1", "h2", "content"))
        many = many.drop("content").join(stage(bytes_of, "hot-contents"), ["key", "h1", "h2"])
        spans = spans.unionByName(_spans(stage(_narrower(many, widths[1]), "regions"), widths[1:]))
    return spans


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("rank"),
                       F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)), text).alias("rid"), text.alias("text"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``spans`` and ``kept`` (in
    place of input columns of these names): the UTF-8 bytes of each whole text
    without those covered by a string of LENGTH bytes that starts at another
    place too, in the same or another document.

    ``spans`` are the removed byte ranges (begin, end), maximal and in order;
    ``kept`` is binary, as a cut may fall inside a character.  Null and empty
    texts have no bytes; rows repeated with id and text are documents that
    repeat each other; an empty table gives an empty result.
    """
    named = _named(docs, id_col, text_col)
    found = stage(regions(named), "regions")
    spans = stage(_spans(found, WIDTHS).groupBy("rid").agg(F.collect_set(F.struct("begin", "end")).alias("spans")), "byte-spans")
    joined = named.drop("text", "rank").join(spans.hint("merge"), "rid", "left").select(
        "row", F.coalesce(F.col("row")[text_col], F.lit("")).alias("text"),
        F.col("spans.begin").alias("begin"), F.col("spans.end").alias("end"))
    schema = (joined.select("row").schema.add("n_bytes", "long").add("n_removed", "long")
              .add("spans", _SPANS).add("kept", "binary"))
    ranges = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, cuts, kept = [], [], [], []
            for text, begin, end in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                raw = text.encode("utf-8")
                merged: list[list[int]] = []
                for b, e in sorted(zip(begin or (), end or ())):
                    if merged and b <= merged[-1][1]:
                        merged[-1][1] = max(e, merged[-1][1])
                    else:
                        merged.append([b, e])
                left = [0, *(e for _, e in merged)]
                kept.append(b"".join(raw[a:b] for a, b in zip(left, [*(b for b, _ in merged), len(raw)])))
                size.append(len(raw))
                gone.append(len(raw) - len(kept[-1]))
                cuts.append([{"begin": b, "end": e} for b, e in merged])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(cuts, ranges), pa.array(kept, pa.binary())],
                names=["row", "n_bytes", "n_removed", "spans", "kept"])
        tb.release()

    new = ("n_bytes", "n_removed", "spans", "kept")
    return joined.mapInArrow(run, schema).select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c not in new], *new)
