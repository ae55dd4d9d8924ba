"""Alignment of two tokenizers over every document.

Both tokenizers see the same bytes (a space and the text).  Where tokens of
both end at the same byte, a group ends; tokens of A and B whose bytes overlap
are linked.  Corpus-wide, the documents that hold an id pair linked are counted
by a minimal perfect hash over the distinct pairs: every run of a task becomes
a dense count vector indexed by the hash, vectors are summed as a tree, and a
second pass over the documents aligns them again and looks its links up, the
keys being compared.

Neither tokenizer joins anything across a single space between two characters
that are not white space: A's pre-tokenizer begins a token there, and no piece
of B has a space behind another character (checked on loading).  So texts are
cut there and every distinct segment of a slice is aligned once; segments met
before are remembered up to a bound.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from cumulo.llm import textbuf as tb
from cumulo.llm.bpe import _byte_chars
from cumulo.llm.common import stage

#: Parts of the pair table: all pairs of one id of A are in one.  Vocabularies
#: bound a part (for 50,000 and 32,000 ids: 13 million pairs).
SHARDS = 128
#: Runs that are summed at once in one task of the tree.
FAN = 32
#: Pairs in tasks' memory in one second pass (some 40 bytes each); beyond it the
#: second pass is done part by part.
PASS_PAIRS = 1 << 21
#: Segments, and pairs with counts, that a task remembers.
MOST_SEGMENTS, MOST_PAIRS = 400_000, 1_000_000
#: Segments that are encoded as one text.
TOGETHER = 500
#: Text that is cut and aligned at once.
SLICE_BYTES = 4_000_000

_CUT = re.compile(r"(?<=\S) (?=\S)")
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True


def _segments(text: str) -> list[str]:
    """``text`` cut at single spaces between other characters; the space in
    front of each (also of the first) is left out."""
    return _CUT.split(text)


def _segment_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where segments begin in texts that have a space in front each.

    Every space is a beginning, except in texts that may have white space next
    to white space: these are cut one by one.
    """
    white = _WHITE[data]
    odd = [np.flatnonzero(white[1:] & white[:-1]), np.flatnonzero((data >= 0xE1) & (data <= 0xE3))]  # U+1000 to U+3FFF
    second = np.flatnonzero(data[:-1] == 0xC2)
    odd.append(second[(data[second + 1] == 0x85) | (data[second + 1] == 0xA0)])
    odd.append(np.flatnonzero(white[-1:]) + len(data) - 1)
    doc = np.unique(np.searchsorted(offs, np.concatenate(odd), "right") - 1)
    starts = np.flatnonzero(data == 0x20)
    if len(doc):
        ragged = np.zeros(len(offs) - 1, bool)
        ragged[doc] = True
        starts = [starts[~ragged[np.searchsorted(offs, starts, "right") - 1]]]
        for d in doc.tolist():
            text = data[offs[d] + 1:offs[d + 1]].tobytes().decode()
            wide = [len(s.encode()) + 1 for s in _segments(text)]
            starts.append(offs[d] + np.cumsum([0, *wide[:-1]]))
        starts = np.sort(np.concatenate(starts))
    return starts


class Aligner:
    """Both tokenizers, and the alignment of segments."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        back = {c: i for i, c in enumerate(_byte_chars())}
        with open(path_a, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        bytes_a = {i: bytes(back[c] for c in t) for t, i in vocab.items() if all(c in back for c in t)}
        self.bytes_a = [bytes_a.get(i, b"") for i in range(max(vocab.values()) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path_b}: a piece has a space inside, texts can't be cut at spaces")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)

    def align(self, segments: list[str]) -> "Aligned":
        """Every segment, with its space in front, in both tokenizers.

        Segments are encoded ``TOGETHER`` at a time, as one text: tokens don't
        cross them.  Where a tokenizer doesn't give back such a text, its
        segments are encoded one by one.
        """
        some = [segments[i:i + TOGETHER] for i in range(0, len(segments), TOGETHER)]
        wide = pc.binary_length(pa.array(segments, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        good, many_a, many_b, flat_a, flat_b = [], [], [], [], []
        for at, part, ids_a, ids_b in zip(range(0, len(segments), TOGETHER), some, *self._ids([" ".join(x) for x in some])):
            ends = np.cumsum(wide[at:at + TOGETHER])
            n_a, n_b = self._split(ids_a, self.length_a, ends), self._split(ids_b, self.length_b, ends)
            if n_a is not None and n_b is not None and self._gives_back(" ".join(part), ids_a, ids_b):
                good.append(np.ones(len(part), bool))
                many_a.append(n_a)
                many_b.append(n_b)
                flat_a.append(ids_a)
                flat_b.append(ids_b)
                continue
            each = [(a, b, self._gives_back(x, a, b)) for x, a, b in zip(part, *self._ids(part))]
            good.append(np.array([ok for _, _, ok in each], bool))
            for ids, many, flat in ((0, many_a, flat_a), (1, many_b, flat_b)):
                many.append(np.array([len(x[ids]) for x in each if x[2]], np.int64))
                flat += [np.array(x[ids], np.int64) for x in each if x[2]]
        none = [np.zeros(0, np.int64)]
        good = np.concatenate([np.zeros(0, bool), *good])
        n_a, n_b, flat_a, flat_b = (np.concatenate(none + [np.asarray(x, np.int64) for x in xs]) for xs in (many_a, many_b, flat_a, flat_b))
        kept = np.flatnonzero(good).tolist()
        end_a, end_b = np.cumsum(self.length_a[flat_a]), np.cumsum(self.length_b[flat_b])
        # the bytes between two neighbouring ends of either tokenizer belong to
        # one token of each: one link; where both end, a group ends
        every = np.sort(np.concatenate([end_a, end_b]))
        twice = every[1:] == every[:-1]
        ends = every[np.append(np.ones(len(every[:1]), bool), ~twice)]
        link_a, link_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        borders = every[1:][twice]
        last = end_a[np.cumsum(n_a) - 1] if len(kept) else end_a
        return Aligned(good, kept, n_a, n_b, flat_a, flat_b,
                       (flat_a[link_a] << 32) | flat_b[link_b], np.searchsorted(ends, last, "right"),
                       np.searchsorted(end_a, borders, "right"), np.searchsorted(end_b, borders, "right"),
                       np.searchsorted(borders, last, "right"))


    def _ids(self, texts: list[str]):
        """Ids of A of each text with a space in front, and of B, which adds it."""
        return ([x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)],
                self.b.encode(texts, num_threads=1))

    def _gives_back(self, text: str, ids_a: list[int], ids_b: list[int]) -> bool:
        raw = b" " + text.encode()
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        return b"".join([bytes_a[i] for i in ids_a]) == raw and b"".join([bytes_b[i] for i in ids_b]) == raw

    @staticmethod
    def _split(ids: list[int], length: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """Tokens of each segment; None where one goes beyond a segment's end."""
        to = np.cumsum(length[np.array(ids, np.int64)])
        at = np.searchsorted(to, ends)
        if not len(to) or at[-1] >= len(to) or (to[at] != ends).any():
            return None
        return np.diff(at + 1, prepend=0)


class Aligned:
    """Alignment of some segments; arrays are over the good ones."""

    def __init__(self, good, kept, n_a, n_b, flat_a, flat_b, links, link_ends, cut_a, cut_b, group_ends):
        self.good, self.kept, self.n_a, self.n_b = good, kept, n_a, n_b
        self.flat_a, self.flat_b = flat_a, flat_b
        self.links, self.link_ends = links, link_ends
        self.cut_a, self.cut_b, self.group_ends = cut_a, cut_b, group_ends

    def texts(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of every good segment."""
        groups = [f"{x}|{y}" for x, y in zip(self.flat_a[self.cut_a - 1].tolist(), self.flat_b[self.cut_b - 1].tolist())]
        # most groups are one token of each; the others are written out
        from_a, from_b = np.append(0, self.cut_a[:-1]), np.append(0, self.cut_b[:-1])
        wide = np.flatnonzero((self.cut_a - from_a[:len(self.cut_a)] > 1) | (self.cut_b - from_b[:len(self.cut_b)] > 1))
        a, b = self.flat_a.tolist(), self.flat_b.tolist()
        for i, a0, a1, b0, b1 in zip(wide.tolist(), *(x[wide].tolist() for x in (from_a, self.cut_a, from_b, self.cut_b))):
            groups[i] = ",".join(map(str, a[a0:a1])) + "|" + ",".join(map(str, b[b0:b1]))
        ends = self.group_ends.tolist()
        return [groups[x] if y == x + 1 else ";".join(groups[x:y]) for x, y in zip([0, *ends], ends)]


@functools.lru_cache(maxsize=2)
def load(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


class _Memory:
    """Segments of a task by number, with the columns ``describe`` gives them."""

    def __init__(self, aligner: Aligner, describe):
        self.aligner, self.describe = aligner, describe
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.columns: list[list] | None = None

    def numbers(self, texts: pa.Array):
        """(segment numbers in text order, number of segments of each text)."""
        if len(self.index) > MOST_SEGMENTS:
            self.clear()
        spaced = pc.binary_join_element_wise(pa.scalar(" "), pc.fill_null(texts, ""), "")
        data, offs = tb.buffer(spaced)
        starts = _segment_starts(data, offs)
        doc = np.searchsorted(offs, starts, "right") - 1
        cut = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        full = (np.diff(offs) > 1)[doc]  # null and empty texts have no segment
        coded = cut.filter(pa.array(full)).dictionary_encode()
        segments, index = coded.dictionary.to_pylist(), self.index
        number = np.array([index.get(s, -1) for s in segments], np.int64)
        unknown = np.flatnonzero(number < 0)
        if len(unknown) or self.columns is None:
            begin, new = len(index), [segments[i] for i in unknown.tolist()]
            number[unknown] = np.arange(begin, begin + len(new))
            index.update(zip(new, range(begin, begin + len(new))))
            columns = self.describe(self.aligner.align([s[1:] for s in new]))
            if self.columns is None:
                self.columns = columns
            else:
                self.columns = [np.concatenate([old, more]) if isinstance(old, np.ndarray) else old + more
                                for old, more in zip(self.columns, columns)]
        return number[coded.indices.to_numpy()], np.bincount(doc[full], minlength=len(texts))


def _spread(values: np.ndarray, aligned: Aligned) -> np.ndarray:
    """Values of the good segments, 0 for the others."""
    out = np.zeros(len(aligned.good), np.int64)
    out[aligned.good] = values
    return out


def _expand(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``start[i] .. start[i] + length[i] - 1`` of every i, one after the other."""
    total = int(length.sum())
    out = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
    return out + np.repeat(start, length)


def pair_runs(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(``shard``, ``pairs``, ``counts``) of every run of a task: the pairs linked
    in its documents (sorted; id of A times 2**32 plus id of B) and how many of these documents hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair_of = np.zeros(0, np.int64)  # segment links by number of the pair
        known: dict[int, int] = {}
        counts = np.zeros(0, np.int64)

        def describe(aligned: Aligned):
            nonlocal pair_of, counts
            pairs, back = np.unique(aligned.links, return_inverse=True)
            numbers = np.array([known.setdefault(p, len(known)) for p in pairs.tolist()], np.int64)
            begin = len(pair_of)
            pair_of = np.concatenate([pair_of, numbers[back]])
            counts = np.concatenate([counts, np.zeros(len(known) - len(counts), np.int64)])
            ends = aligned.link_ends
            starts = np.concatenate([[0], ends[:-1]])[:len(ends)]
            return [aligned.good, _spread(starts + begin, aligned), _spread(ends - starts, aligned)]

        memory = _Memory(load(path_a, path_b), describe)

        def flush() -> pa.RecordBatch:
            nonlocal pair_of, counts
            pairs = np.fromiter(known, np.int64, len(known))
            held = np.flatnonzero(counts)
            pairs, n = pairs[held], counts[held]
            shard = (pairs >> 32) % SHARDS
            order = np.lexsort((pairs, shard))
            pairs, n, shard = pairs[order], n[order], shard[order]
            begin = tb.runs_of(shard)
            bounds = list(zip(begin.tolist(), [*begin[1:].tolist(), len(shard)]))
            out = pa.RecordBatch.from_arrays(
                [pa.array(shard[begin], pa.int32()),
                 pa.array([pairs[a:b].tobytes() for a, b in bounds], pa.binary()),
                 pa.array([n[a:b].tobytes() for a, b in bounds], pa.binary())], names=["shard", "pairs", "counts"])
            memory.clear()
            known.clear()
            pair_of, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            return out

        for batch in batches:
            for part in tb.slices(batch, 0, SLICE_BYTES):
                if len(known) > MOST_PAIRS:
                    yield flush()
                if len(memory.index) > MOST_SEGMENTS:  # their links are dropped with them
                    memory.clear()
                    pair_of = np.zeros(0, np.int64)
                at, sizes = memory.numbers(part.column(0))
                good, start, length = memory.columns
                doc = np.repeat(np.arange(len(sizes)), sizes)
                whole = np.bincount(doc[~good[at]], minlength=len(sizes)) == 0
                use = whole[doc]
                at, doc = at[use], doc[use]
                pair = pair_of[_expand(start[at], length[at])]
                keys = np.sort((np.repeat(doc, length[at]) << 32) | pair)
                counts += np.bincount(keys[tb.runs_of(keys)] & 0xFFFFFFFF, minlength=len(counts))
        yield flush()
        tb.release()

    return docs.mapInArrow(run, "shard int, pairs binary, counts binary")


class PerfectHash:
    """Minimal perfect hash: keys that are alone at their place of a level get
    it, the others go on to the next level; a key's slot is the number of
    places taken before its own."""

    GAMMA = 2.0

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # places taken, as booleans
        counts = [int(x.sum()) for x in levels]
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.ranks = [np.cumsum(x, dtype=np.int32) - x for x in levels]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = tb.U64(0x9E3779B97F4A7C15 * (2 * level + 1) & 0xFFFFFFFFFFFFFFFF)
        return (tb.mix(keys.astype(np.uint64) * tb.U64(0xD6E8FEB86659FD93) + seed) % tb.U64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        levels, left = [], keys
        while len(left):
            size = max(8, int(len(left) * cls.GAMMA))
            place = cls._place(left, len(levels), size)
            taken = np.bincount(place, minlength=size) == 1
            levels.append(taken)
            left = left[~taken[place]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 or any slot for a key that was not built in."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, taken in enumerate(self.levels):
            place = self._place(keys[left], level, len(taken))
            hit = taken[place]
            out[left[hit]] = self.ranks[level][place[hit]] + self.before[level]
            left = left[~hit]
        return out

    def pack(self) -> tuple[list[int], bytes]:
        return [len(x) for x in self.levels], b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def unpack(cls, sizes, raw: bytes) -> "PerfectHash":
        levels, at = [], 0
        for n in sizes:
            many = -(-n // 8)
            levels.append(np.unpackbits(np.frombuffer(raw[at:at + many], np.uint8), count=n).astype(bool))
            at += many
        return cls(levels)


def _longs(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int64) for x in column.to_pylist()]


def _levels(runs: DataFrame) -> list[int]:
    """Rows of a shard in every step of a tree that joins ``FAN`` at a time."""
    most = runs.groupBy("shard").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    steps = []
    while most > 1:
        most = -(-most // FAN)
        steps.append(most)
    return steps or [1]


def pair_table(runs: DataFrame) -> DataFrame:
    """(``shard``, ``sizes``, ``hash``, ``pairs``, ``counts``, ``best``) per
    shard: its minimal perfect hash, and by slot the pair, its documents and
    whether no pair of the same id of A has more."""
    numbered = stage(runs.withColumn("row", F.xxhash64(F.monotonically_increasing_id())), "pair-runs")
    steps = _levels(numbered)

    def union(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        pairs = np.unique(np.concatenate(_longs(table.column("pairs"))))
        return pa.table({"shard": [key[0].as_py()], "row": [key[1].as_py()], "pairs": [pairs.tobytes()]},
                        schema=pa.schema([("shard", pa.int32()), ("row", pa.int64()), ("pairs", pa.binary())]))

    keys = numbered.select("shard", "row", "pairs")
    for step in steps:
        keys = stage(keys.withColumn("row", F.pmod("row", F.lit(step))).groupBy("shard", "row")
                     .applyInArrow(union, "shard int, row long, pairs binary"), "pair-keys")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, pairs in zip(batch.column(0).to_pylist(), _longs(batch.column(1))):
                made = PerfectHash.build(pairs)
                by_slot = np.zeros(len(pairs), np.int64)
                by_slot[made.slots(pairs)] = pairs
                sizes, raw = made.pack()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([sizes], pa.list_(pa.int64())), pa.array([raw], pa.binary()),
                     pa.array([by_slot.tobytes()], pa.binary())], names=["shard", "sizes", "hash", "pairs"])

    hashes = stage(keys.select("shard", "pairs").mapInArrow(build, "shard int, sizes array<long>, hash binary, pairs binary"), "pair-hash")

    def vectors(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        made = PerfectHash.unpack(right.column("sizes")[0].as_py(), right.column("hash")[0].as_py())
        by_slot = np.frombuffer(right.column("pairs")[0].as_py(), np.int64)
        total = np.zeros(len(by_slot), np.int64)
        for pairs, counts in zip(_longs(left.column("pairs")), _longs(left.column("counts"))):
            slot = made.slots(pairs)
            if (slot < 0).any() or (by_slot[slot] != pairs).any():
                raise ValueError("a pair of a run is not in its shard's hash")
            total[slot] += counts
        return _vector(key, total)

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _vector(key, functools.reduce(np.add, _longs(table.column("counts"))))

    def _vector(key, total: np.ndarray) -> pa.Table:
        return pa.table({"shard": [key[0].as_py()], "row": [key[1].as_py()], "counts": [total.tobytes()]},
                        schema=pa.schema([("shard", pa.int32()), ("row", pa.int64()), ("counts", pa.binary())]))

    first = steps[0]
    dense = numbered.withColumn("row", F.pmod("row", F.lit(first)))
    each = hashes.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(first - 1).cast("long"))))
    schema = "shard int, row long, counts binary"
    sums = stage(dense.groupBy("shard", "row").cogroup(
        each.join(dense.select("shard", "row").distinct(), ["shard", "row"], "left_semi").groupBy("shard", "row"))
        .applyInArrow(vectors, schema), "pair-counts")
    for step in steps[1:]:
        sums = stage(sums.withColumn("row", F.pmod("row", F.lit(step))).groupBy("shard", "row").applyInArrow(add, schema), "pair-counts")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for pairs, counts in zip(_longs(batch.column("pairs")), _longs(batch.column("counts"))):
                most = np.zeros(int((pairs >> 32).max()) + 1 if len(pairs) else 0, np.int64)
                np.maximum.at(most, pairs >> 32, counts)
                best.append((counts == most[pairs >> 32]).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.binary())], names=[*batch.schema.names, "best"])

    whole = hashes.join(sums.select("shard", "counts"), "shard").select("shard", "sizes", "hash", "pairs", "counts")
    return stage(whole.mapInArrow(rank, StructType([*whole.schema.fields, StructField("best", BinaryType())])), "pair-table")


class _Lookup:
    """Counts and best marks of pairs, from some shards of the pair table."""

    def __init__(self, rows):
        self.shards = {}
        for r in rows:
            self.shards[r["shard"]] = (PerfectHash.unpack(r["sizes"], bytes(r["hash"])), np.frombuffer(r["pairs"], np.int64),
                                       np.frombuffer(r["counts"], np.int64), np.frombuffer(r["best"], np.uint8))

    def of(self, pairs: np.ndarray):
        """(documents, best) of each pair; 0 for pairs of other shards, and for
        those that are in no document with tokens (their texts have none)."""
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        shard = (pairs >> 32) % SHARDS
        order = np.argsort(shard, kind="stable")
        begin = tb.runs_of(shard[order])
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(order)]):
            found = self.shards.get(int(shard[order[a]]))
            if found:
                made, by_slot, counts, bests = found
                at = order[a:b]
                slot = made.slots(pairs[at])
                own = (slot >= 0) & (by_slot[slot] == pairs[at])  # the keys are compared
                at, slot = at[own], slot[own]
                count[at], best[at] = counts[slot], bests[slot]
        return count, best


_SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _second_pass(docs: DataFrame, keep: list[str], path_a: str, path_b: str, table, first: bool, last: bool) -> DataFrame:
    """``keep`` columns, the text unless it is the last pass, the sums so far
    with the pairs of this pass added, and the groups in the last pass."""
    rows = docs.select(*keep, "_text", *([] if first else [F.col(f"_{c}") for c in _SUMS]))
    schema = rows.select(*keep, *([] if last else ["_text"])).schema
    for c in _SUMS:
        schema = schema.add(c if last else f"_{c}", LongType())
    if last:
        schema = schema.add("groups", StringType())
    at_text = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(table.value)

        def describe(aligned: Aligned):
            count, best = lookup.of(aligned.links)
            ends = aligned.link_ends
            starts = np.concatenate([[0], ends[:-1]])[:len(ends)].astype(np.int64)
            total = np.concatenate([[0], np.cumsum(count)])
            bests = np.concatenate([[0], np.cumsum(best)])
            groups = np.diff(aligned.group_ends, prepend=0)
            texts = [""] * len(aligned.good)
            if last:
                for i, t in zip(aligned.kept, aligned.texts()):
                    texts[i] = t
            return [aligned.good, *[_spread(v, aligned) for v in (
                aligned.n_a, aligned.n_b, groups, ends - starts, bests[ends] - bests[starts], total[ends] - total[starts])], texts]

        memory = _Memory(load(path_a, path_b), describe)
        for batch in batches:
            for part in tb.slices(batch, at_text, SLICE_BYTES):
                at, sizes = memory.numbers(part.column(at_text))
                good, *columns, texts = memory.columns
                n = part.num_rows
                doc = np.repeat(np.arange(n), sizes)
                whole = np.bincount(doc[~good[at]], minlength=n) == 0
                sums = []
                for i, values in enumerate(columns):
                    # whole numbers throughout: differences of a running sum
                    run_sum = np.concatenate([[0], np.cumsum(values[at])])
                    to = np.cumsum(sizes)
                    own = np.where(whole, run_sum[to] - run_sum[to - sizes], 0)
                    if not first and i >= 4:
                        own = own + part.column(at_text + 1 + i).to_numpy()
                    sums.append(pa.array(own, pa.int64()))
                out = [*part.columns[:at_text], *([] if last else [part.column(at_text)]), *sums]
                if last:
                    groups, begin = [], 0
                    numbers = at.tolist()
                    for size, ok in zip(sizes.tolist(), whole.tolist()):
                        groups.append(";".join([texts[j] for j in numbers[begin:begin + size]]) if ok else "")
                        begin += size
                    out.append(pa.array(groups, pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)
        tb.release()

    return rows.mapInArrow(run, schema)


def align(docs: DataFrame, path_a: str, path_b: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus ``n_a``, ``n_b`` (tokens), ``n_groups``,
    ``n_links``, ``n_best`` (links whose pair is in as many documents as any
    pair of its id of A), ``count_sum`` (documents with the pair, over all
    links) and ``groups`` (``a1,a2|b1;a3|b2,b3``: ids of A and B per group).

    Null and empty texts, and texts that a tokenizer does not give back byte
    by byte, have no tokens: zeros and ''.  Repeated rows count as often as
    they stand there.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    names = [f"_keep{i}" for i in range(len(keep))]  # any name may clash with the columns added here
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text_col).alias("_text"))
    table = pair_table(pair_runs(rows.select("_text"), path_a, path_b))
    sizes = {r["shard"]: r["n"] for r in table.select("shard", (F.length("pairs") / 8).alias("n")).collect()}  # a row per shard
    passes, room = [[]], 0
    for shard, n in sorted(sizes.items()):
        if passes[-1] and room + n > PASS_PAIRS:
            passes.append([])
            room = 0
        passes[-1].append(shard)
        room += n
    for i, shards in enumerate(passes):
        part = spark.sparkContext.broadcast([r.asDict() for r in table.filter(F.col("shard").isin(shards)).collect()])
        last = i == len(passes) - 1
        rows = _second_pass(rows, names, path_a, path_b, part, i == 0, last)
        if not last:
            rows = stage(rows, "aligned")
    return rows.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], *_SUMS, "groups")
