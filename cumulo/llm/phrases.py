"""Phrase collocations by HAT-trie counting.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and
pieces into words.  Every task counts the word sequences of its texts in a
HAT-trie: a shallow trie over word ids whose leaves are hash containers, which
burst into a node when they grow.  A trie over its memory bound spills whole
subtrees, largest first, as sorted runs; runs of the same prefix (language and
first two words) meet in one partition, where they are merged.

Texts are read four times: for words, for pairs of frequent words, for triples
of frequent pairs, and for the sequences of two to five words all of whose
pairs and triples are frequent.  A frequent sequence has only frequent parts, so
nothing is lost.  Most pairs and triples are rare, so the second and third
reading add up fingerprints only.  What is frequent is
told to tasks by a bit table of fixed size: a collision lets a rare sequence be
counted for nothing, and counts stay exact, as they are of the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cumulo.llm import textbuf as tb
from cumulo.llm.common import free_name, stage

LONGEST = 5
#: Bits of a table of frequent sequences: 4 MB, whatever the input.
TABLE_BITS = 25
#: Entries of a container before it bursts, and of a task's trie and its word
#: list before subtrees are spilled.
BURST, MOST_ENTRIES, MOST_WORDS = 4096, 400_000, 250_000
#: Word ids inside a packed tail; words that are counted at once.
ID_BITS, STEP = 20, 300_000
#: Bits of a pair's fingerprint, pairs a task sorts at once, and groups in which
#: fingerprints are added up, per shuffle partition.
PAIR_BITS, MOST_PAIRS, PAIR_GROUPS = 40, 4_000_000, 8
#: Salts of the first step of the ranking.
SALTS = 64

_CUT = np.zeros(256, dtype=np.uint8)
_CUT[[0x20, 0x09]] = 1
_CUT[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2


def _words(texts: pa.Array):
    """(Arrow words, document of each, piece of each) in text order."""
    data, offs = tb.buffer(texts)
    data = tb.LOWER[data]
    kind = _CUT[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begin = offs[(offs > 0) & (offs < len(data))]
    first[begin] = inside[begin]
    starts = np.flatnonzero(first)
    doc = np.searchsorted(offs, starts, "right") - 1
    piece = np.cumsum(kind == 2)[starts] + doc
    places = np.append(np.cumsum(inside)[starts] - 1, inside.sum()) if len(starts) else np.zeros(1, np.int64)
    words = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(places.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[inside])))
    return words, doc, piece


def _buckets(codes: np.ndarray, width: int) -> np.ndarray:
    """Place of every run of ``width`` words in a bit table, from word codes."""
    return (tb.window_hash(codes, width) >> tb.U64(64 - TABLE_BITS)).astype(np.int64)


def _code(lang: str, word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode(), xxhash.xxh64_intdigest(lang.encode()))


class HatTrie:
    """Counts of word sequences: first word -> hash container of (second word,
    packed tail), or, once burst, -> second word -> hash container of tails."""

    def __init__(self):
        self.roots: dict[int, dict] = {}
        self.burst: set[int] = set()
        self.sizes: dict[int, int] = {}
        self.entries = 0

    def add(self, first: int, second: int, tails: list[int], counts: list[int]) -> None:
        root = self.roots.setdefault(first, {})
        if first in self.burst:
            box, high = root.setdefault(second, {}), 0
        else:
            box, high = root, second << (3 * ID_BITS)
        had = len(box)
        for tail, n in zip(tails, counts):
            key = high | tail
            box[key] = box.get(key, 0) + n
        new = len(box) - had
        self.entries += new
        self.sizes[first] = self.sizes.get(first, 0) + new
        if box is root and len(root) > BURST:
            self._split(first)

    def _split(self, first: int) -> None:
        low = (1 << (3 * ID_BITS)) - 1
        node: dict[int, dict] = {}
        for key, n in self.roots[first].items():
            node.setdefault(key >> (3 * ID_BITS), {})[key & low] = n
        self.roots[first] = node
        self.burst.add(first)

    def take(self, first: int):
        """Remove the subtree of a first word: (second, tail, count) of its entries."""
        root = self.roots.pop(first)
        self.entries -= self.sizes.pop(first)
        if first in self.burst:
            self.burst.discard(first)
            return [(second, tail, n) for second, box in root.items() for tail, n in box.items()]
        low = (1 << (3 * ID_BITS)) - 1
        return [(key >> (3 * ID_BITS), key & low, n) for key, n in root.items()]

    def largest(self) -> list[int]:
        return sorted(self.sizes, key=self.sizes.get, reverse=True)


class _Counter:
    """One task's trie with the words its ids stand for."""

    def __init__(self):
        self.trie = HatTrie()
        self.ids: dict[tuple[str, str], int] = {}
        self.words: list[tuple[str, str]] = []

    def number(self, lang: str, words: list[str]) -> np.ndarray:
        ids = []
        for w in words:
            key = (lang, w)
            i = self.ids.get(key)
            if i is None:
                i = self.ids[key] = len(self.words)
                self.words.append(key)
            ids.append(i)
        return np.array(ids, np.int64)

    def full(self) -> bool:
        return len(self.words) > MOST_WORDS

    def count(self, lang: str, vocabulary: list[str], word: np.ndarray, good: dict[int, np.ndarray], piece: np.ndarray,
              lengths: tuple[int, ...]) -> None:
        """Add the sequences that begin in the first ``STEP`` of some
        consecutive words to the trie, each distinct one once; ``good``: where
        frequent runs of so many words begin."""
        starts = []
        for width in lengths:
            at = tb.window_starts(piece, width)
            at = at[at < STEP]
            known = min(width, max(good))
            for j in range(width - known + 1):
                at = at[good[known][at + j]]
            starts.append(at)
        if not any(len(at) for at in starts):
            return
        used = np.unique(np.concatenate([word[at + j] for at, width in zip(starts, lengths) for j in range(width)]))
        ids = np.zeros(len(vocabulary), np.int64)
        ids[used] = self.number(lang, [vocabulary[i] for i in used.tolist()])
        word = ids[word]
        heads, tails = [], []
        for at, width in zip(starts, lengths):
            heads.append((word[at] << 32) | word[at + 1])
            tail = np.zeros(len(at), np.int64)
            for j in range(2, width):
                tail |= (word[at + j] + 1) << (ID_BITS * (4 - j))
            tails.append(tail)
        head, tail = np.concatenate(heads), np.concatenate(tails)
        order = np.lexsort((tail, head))
        head, tail = head[order], tail[order]
        begin = tb.runs_of(head, tail)
        count = np.diff(np.append(begin, len(head)))
        head, tail = head[begin], tail[begin]
        group = np.append(tb.runs_of(head), len(head)).tolist()
        heads, tails, counts = head.tolist(), tail.tolist(), count.tolist()
        for a, b in zip(group, group[1:]):
            self.trie.add(heads[a] >> 32, heads[a] & 0xFFFFFFFF, tails[a:b], counts[a:b])

    def spill(self, everything: bool, parts: int) -> Iterator[pa.RecordBatch]:
        """Whole subtrees, the largest first, until half is free, as a sorted run
        per prefix partition: (``part``, ``lang``, ``phrases``, ``counts``)."""
        mask = (1 << ID_BITS) - 1
        runs: dict[tuple[int, str], list[tuple[str, int]]] = {}
        for first in self.trie.largest():
            if not everything and self.trie.entries <= MOST_ENTRIES // 2:
                break
            lang, head = self.words[first]
            for second, tail, n in self.trie.take(first):
                seq = [head, self.words[second][1]]
                for at in (2, 1, 0):
                    i = (tail >> (at * ID_BITS)) & mask
                    if i:
                        seq.append(self.words[i - 1][1])
                # the partition is the prefix's, with a few of its own, lest it be hot
                part = (_code(lang, f"{head} {seq[1]}") + len(seq)) % parts
                runs.setdefault((part, lang), []).append((" ".join(seq), n))
        if everything:
            self.ids.clear()
            self.words.clear()
        for (part, lang), run in sorted(runs.items()):
            run.sort()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([lang]), pa.array([[p for p, _ in run]], pa.list_(pa.string())),
                 pa.array([[n for _, n in run]], pa.list_(pa.int64()))], names=["part", "lang", "phrases", "counts"])


def _parts(batch: pa.RecordBatch):
    """(language, texts) of every language of a batch, in slices of bounded size."""
    for part in tb.slices(batch, 1):
        for lang in pc.unique(part.column(0)):
            yield lang.as_py(), part.column(1).filter(pc.equal(part.column(0), lang))


def count_words(rows: DataFrame) -> DataFrame:
    """(``lang``, ``phrase``, ``n``) of every word of ``rows`` (``lang``,
    ``text``), and one row per language with a null phrase: all its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str | None], int] = {}

        def emit():
            keys = sorted(counts, key=lambda k: (k[0], k[1] or ""))
            out = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([counts[k] for k in keys], pa.int64())], names=["lang", "phrase", "n"])
            counts.clear()
            return out

        for batch in batches:
            for lang, texts in _parts(batch):
                words, _, _ = _words(texts)
                if not len(words):
                    continue
                coded = words.dictionary_encode()
                n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)).tolist()
                for w, k in zip(coded.dictionary.to_pylist(), n):
                    key = (lang, w)
                    counts[key] = counts.get(key, 0) + k
                counts[lang, None] = counts.get((lang, None), 0) + len(words)
                if len(counts) > MOST_ENTRIES:
                    yield emit()
        yield emit()
        tb.release()

    found = rows.mapInArrow(run, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _word_places(words: DataFrame) -> DataFrame:
    """Places of words (``lang``, ``phrase``) in a bit table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([_code(*x) for x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_buckets(codes, 1))], names=["place"])

    return words.select("lang", "phrase").mapInArrow(run, "place long")


def _bit_table(places: DataFrame) -> np.ndarray:
    """Bit table with these places (``place``) set: put together by Spark, of
    fixed size."""
    at = F.col("place") + 1  # Spark's bitmaps count from 1
    bits = places.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    table = np.zeros(1 << TABLE_BITS, dtype=bool)
    for row in bits.collect():  # at most 2**25 bits
        part = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little")
        table[np.flatnonzero(part) + (row["part"] - 1) * len(part)] = True
    return np.packbits(table, bitorder="little")


def _marked(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (table[places >> 3] >> (places & 7).astype(np.uint8)) & np.uint8(1) == 1


def _packed(values: np.ndarray) -> bytes:
    """Sorted whole numbers: differences, byte by byte, compressed."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(raw, n * 8, "zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(flat.reshape(8, n).T).view(np.uint64).ravel(), dtype=np.uint64)


def _summed(hashes: np.ndarray, counts: np.ndarray):
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    begin = tb.runs_of(hashes)
    return hashes[begin], (np.add.reduceat(counts[order], begin) if len(begin) else counts)


def frequent_runs(rows: DataFrame, table, width: int, least: int) -> DataFrame:
    """Places (``place``) of the runs of ``width`` words that occur ``least``
    times or more, by fingerprint; of runs whose two shorter parts are marked
    in the bit table.  Sorted fingerprints and counts are split by range and
    added up."""
    parts = PAIR_GROUPS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def emit():
            hashes, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            part = (hashes >> tb.U64(PAIR_BITS - 24)) * tb.U64(parts) >> tb.U64(24)
            begin = tb.runs_of(part)
            ends = [*begin[1:].tolist(), len(part)]
            return pa.RecordBatch.from_arrays(
                [pa.array(part[begin].astype(np.int32)), pa.array([b - a for a, b in zip(begin.tolist(), ends)], pa.int32()),
                 pa.array([_packed(hashes[a:b]) for a, b in zip(begin.tolist(), ends)], pa.binary()),
                 pa.array([pa.compress(counts[a:b].astype(np.uint32).tobytes(), "zstd", asbytes=True) for a, b in zip(begin.tolist(), ends)],
                          pa.binary())], names=["part", "n", "hashes", "counts"])

        for batch in batches:
            for lang, texts in _parts(batch):
                words, _, piece = _words(texts)
                if not len(words):
                    continue
                coded = words.dictionary_encode()
                codes = np.array([_code(lang, w) for w in coded.dictionary.to_pylist()], np.uint64)
                codes = codes[coded.indices]
                known = _marked(table.value, _buckets(codes, width - 1))
                at = tb.window_starts(piece, width)
                at = at[known[at] & known[at + 1]]
                held.append(tb.window_hash(codes, width)[at] >> tb.U64(64 - PAIR_BITS))
                if sum(map(len, held)) > MOST_PAIRS:
                    yield emit()
        if held:
            yield emit()
        tb.release()

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        some, many, size = [], [], 0
        for n, h, c in zip(*(table.column(x).to_pylist() for x in ("n", "hashes", "counts"))):
            some.append(_unpacked(h, n))
            many.append(np.frombuffer(pa.decompress(c, n * 4, "zstd", asbytes=True), np.uint32).astype(np.int64))
            size += n
            if size > MOST_PAIRS:
                hashes, counts = _summed(np.concatenate([hashes, *some]), np.concatenate([counts, *many]))
                some, many, size = [], [], 0
        hashes, counts = _summed(np.concatenate([hashes, *some]), np.concatenate([counts, *many]))
        often = hashes[counts >= least]
        return pa.table({"place": pa.array((often >> tb.U64(PAIR_BITS - TABLE_BITS)).astype(np.int64))})

    runs = rows.mapInArrow(run, "part int, n int, hashes binary, counts binary")
    return runs.groupBy("part").applyInArrow(add, "place long")


def count_sequences(rows: DataFrame, tables: dict, lengths: tuple[int, ...], least: int) -> DataFrame:
    """(``lang``, ``phrase``, ``n``) of the sequences of the given lengths that
    occur ``least`` times or more; all their runs are marked in ``tables`` (bit
    tables by the runs' words).  Sorted runs of one prefix partition meet in one
    group, which holds what a shuffle partition holds, and are merged there."""
    parts = PAIR_GROUPS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()
        for batch in batches:
            for lang, texts in _parts(batch):
                words, _, piece = _words(texts)
                if not len(words):
                    continue
                coded = words.dictionary_encode()
                vocabulary = coded.dictionary.to_pylist()
                codes = np.array([_code(lang, w) for w in vocabulary], np.uint64)
                word = coded.indices.to_numpy().astype(np.int64)
                good = {}
                for known, table in tables.items():
                    good[known] = np.zeros(len(word), dtype=bool)  # a marked run begins here
                    at = tb.window_starts(piece, known)
                    good[known][at] = _marked(table.value, _buckets(codes[word], known)[at])
                for lo in range(0, len(word), STEP):  # a long text has many steps
                    hi = lo + STEP + LONGEST - 1
                    counter.count(lang, vocabulary, word[lo:hi], {k: g[lo:hi] for k, g in good.items()}, piece[lo:hi], lengths)
                    if counter.full():
                        yield from counter.spill(True, parts)
                    elif counter.trie.entries > MOST_ENTRIES:
                        yield from counter.spill(False, parts)
        yield from counter.spill(True, parts)
        tb.release()

    def merge(key: tuple[pa.Scalar, ...], runs: pa.Table) -> pa.Table:
        sizes = pc.list_value_length(runs.column("phrases").combine_chunks())
        every = pa.table({"lang": runs.column("lang").combine_chunks().take(pa.array(np.repeat(np.arange(len(sizes)), sizes.to_numpy()))),
                          "phrase": runs.column("phrases").combine_chunks().flatten(), "n": runs.column("counts").combine_chunks().flatten()})
        total = every.group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        often = total.filter(pc.greater_equal(total.column("n_sum"), least))
        return pa.table({"lang": often.column("lang"), "phrase": often.column("phrase"), "n": often.column("n_sum")})

    runs = rows.mapInArrow(run, "part int, lang string, phrases array<string>, counts array<long>")
    return runs.groupBy("part").applyInArrow(merge, "lang string, phrase string, n long")


def frequent_phrases(rows: DataFrame, least: int):
    """(words and phrases of one to five words counted at least ``least`` times
    (``lang``, ``phrase``, ``n``), words per language (``lang``, ``total``))."""
    spark = rows.sparkSession
    counted = stage(count_words(rows).filter((F.col("n") >= least) | F.col("phrase").isNull()), "phrase-words")
    totals = counted.filter("phrase is null").select("lang", F.col("n").alias("total"))
    words = counted.filter(F.col("phrase").isNotNull() & (F.col("n") >= least))
    tables = {1: spark.sparkContext.broadcast(_bit_table(_word_places(words)))}
    for width in (2, 3):
        tables[width] = spark.sparkContext.broadcast(_bit_table(frequent_runs(rows, tables[width - 1], width, least)))
    del tables[1]
    found = count_sequences(rows, tables, tuple(range(2, LONGEST + 1)), least)
    return stage(words.unionByName(found), "frequent-phrases"), totals


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's ``top`` phrases: ``lang``, ``rank``, ``phrase``, ``a``
    (its count), ``l`` and ``r`` (the counts of the two parts of its cut),
    ``n`` (all words of the language), ``score``.

    A phrase of two to five words counted at least ``least`` times is a
    candidate.  Its score is the least floor(1000 a n / (l r)) over its cuts,
    ties to the first cut.  A candidate inside a longer one that occurs as
    often is dropped.  Null languages count as ``und``, null texts as empty;
    repeated rows count as often as they stand there.  Languages without a
    candidate have no rows, an empty table none at all.
    """
    own = free_name(docs.columns, "_lang")
    rows = docs.withColumn(own, F.coalesce(F.col(lang_col), F.lit("und"))).select(
        F.col(own).alias("lang"), F.col(text_col).alias("text"))
    counted, totals = frequent_phrases(rows, least)
    phrases = counted.withColumn("w", F.split("phrase", " ")).withColumn("size", F.size("w"))
    candidates = phrases.filter("size > 1")

    inner = F.expr("filter(flatten(transform(sequence(1, size), i -> transform(sequence(2, 5), k -> "
                   "if(i + k - 1 <= size and k < size, array_join(slice(w, i, k), ' '), null)))), x -> x is not null)")
    inside = (candidates.filter("size > 2").select("lang", "n", F.explode(F.array_distinct(inner)).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("n").alias("longer")))
    alone = stage(candidates.join(stage(inside, "inner-phrases"), ["lang", "phrase"], "left")
                  .filter(F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("n")))
                  .select("lang", "phrase", F.col("n").alias("a"), "w", "size"), "outer-phrases")

    cuts = alone.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("left"),
        F.expr("array_join(slice(w, k + 1, size - k), ' ')").alias("right"))
    counts = counted.select("lang", "phrase", "n")
    scored = (stage(cuts, "phrase-cuts")
              .join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
              .join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
              .join(totals, "lang"))
    # products pass 64 bits: decimals, whose whole-number division is exact
    score = F.expr("(1000 * cast(a as decimal(16,0)) * cast(total as decimal(16,0))) div "
                   "(cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    best = scored.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", F.col("total").alias("n"))).alias("cut")).select("lang", "phrase", "cut.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for keys in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))], ["lang"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
