"""MinHash near-dedup by improved consistent weighted sampling.

Documents are weighted sets of five-word shingles (term frequency times
inverse document frequency).  Every consistent weighted sample of two
documents agrees with the probability of their weighted Jaccard similarity;
samples are banded, documents that share a band are compared, and a pair
links only if its weighted Jaccard, computed from the whole texts, reaches
the threshold.  Links are closed by connected components.

Equal texts are one class from the start.  Nobody emits all pairs of a
bucket.  Its members are compared with a leader first; then components of the
links found so far are joined, and only buckets that still hold several
components go on: members of buckets of at most ``SMALL`` with all members of
other components, texts of larger buckets with those that share one of their
rarest shingles, which is exact: see ``_rarest`` and ``_by_rarest``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from cumulo.llm import textbuf as tb
from cumulo.llm.common import discard, free_name, stage
from cumulo.llm.components import stars

SHINGLE, BANDS, ROWS = 5, 10, 3
#: Buckets of the document-frequency table: the only thing that is collected
#: and broadcast, of fixed size.
DF_BUCKETS = 1 << 18
LAST = 2**63 - 1
KEY_BITS = tb.U64(44)
KEY_MASK = tb.U64((1 << 44) - 1)
#: Members up to which a band bucket is compared to the end; see ``_links``.
SMALL = 32
#: Total weights of one class differ by this factor at most, and slack for
#: sums of weights in another order; see ``_rarest``.
CLASS, SLACK = 1.02, 1e-6


def _shingle_codes(texts: pa.Array) -> np.ndarray:
    """Document (20 bits) and shingle (44 bits) of every shingle, unsorted; a
    text of fewer words than a shingle has its whole word sequence as the only
    one.  At most 2**20 texts at once."""
    data, offs = tb.buffer(texts)
    s, e, doc = tb.words(data, offs)
    value = tb.Rolling(data).of(s, e)
    at = tb.window_starts(doc, SHINGLE)
    docs, keys = doc[at], tb.window_hash(value, SHINGLE)[at]
    sizes = np.bincount(doc, minlength=len(offs) - 1)
    few = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(few):
        first = np.searchsorted(doc, few)
        short = [tb.window_hash(value[f:f + sizes[d]], int(sizes[d]))[0] for d, f in zip(few, first)]
        docs, keys = np.append(docs, few), np.append(keys, np.array(short, np.uint64))
    return (docs.astype(np.uint64) << KEY_BITS) | (keys >> tb.U64(20))


def shingles(texts: pa.Array):
    """(document, shingle, term frequency) sorted by both."""
    codes = np.sort(_shingle_codes(texts))
    new = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][:len(codes)])
    return ((codes[new] >> KEY_BITS).astype(np.int64), codes[new] & KEY_MASK,
            np.diff(np.append(new, len(codes))))


def document_frequency(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Inverse document frequency per shingle bucket, over all documents:
    1 + ln(n / df) / ln(n), between 1 (in all documents) and 2.  The bound
    keeps copies alike: what a large group of near copies shares is frequent
    just because of them, and must not lose to their few different words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DF_BUCKETS + 1, np.int64)  # the last entry counts documents
        for batch in batches:
            df[-1] += batch.num_rows
            for part in tb.slices(batch, 0):
                codes = _shingle_codes(part.column(0))
                pairs = np.sort((codes >> KEY_BITS) * tb.U64(DF_BUCKETS) + codes % tb.U64(DF_BUCKETS))
                pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]][:len(pairs)]]
                df[:-1] += np.bincount((pairs % tb.U64(DF_BUCKETS)).astype(np.int64), minlength=DF_BUCKETS)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(df[seen])], names=["bucket", "df"])

    rows = (docs.select(F.col(text_col)).mapInArrow(run, "bucket int, df long")
            .groupBy("bucket").agg(F.sum("df").alias("df")).toPandas())
    df = np.zeros(DF_BUCKETS + 1)
    df[rows["bucket"].to_numpy(dtype=np.int64)] = rows["df"].to_numpy()
    n = max(df[-1], 2)
    return (1 + np.log(n / np.clip(df[:-1], 1, n)) / np.log(n)).astype(np.float32)


def _gamma_quantiles(n: int = 1 << 16) -> np.ndarray:
    """Mid-cell quantiles of Gamma(2, 1), by bisection of 1 - (1 + x) exp(-x)."""
    p = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = -np.expm1(-mid) - mid * np.exp(-mid) < p
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return low


class Sampler:
    """Consistent weighted samples: for shingle k and sample h the variables
    r, c ~ Gamma(2, 1) and b ~ U(0, 1) come from a hash of both; of all
    shingles the one with the least c / (y e^r) is taken, where
    t = floor(ln w / r + b) and ln y = r (t - b)."""

    def __init__(self):
        gamma = _gamma_quantiles()
        self.r, self.log_c = gamma.astype(np.float32), np.log(gamma).astype(np.float32)
        self.b = ((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)
        rng = np.random.default_rng(41)
        self.odd = rng.integers(2**40, 2**62, (BANDS * ROWS, 2), dtype=np.uint64) * tb.U64(2) + tb.U64(1)

    def sample(self, doc: np.ndarray, key: np.ndarray, weight: np.ndarray):
        """(documents that have shingles, documents x BANDS band hashes)."""
        starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(doc))))
        log_w = np.log(weight)
        bands = np.zeros((len(starts), BANDS), np.uint64)
        low = tb.U64(0xFFFF)
        for h in range(BANDS * ROWS):
            x = (key + tb.U64(1)) * self.odd[h, 0]
            x ^= x >> tb.U64(32)
            x *= self.odd[h, 1]
            r = self.r[(x >> tb.U64(48)).astype(np.uint16)]
            b = self.b[((x >> tb.U64(32)) & low).astype(np.uint16)]
            t = np.floor(log_w / r + b)
            score = self.log_c[((x >> tb.U64(16)) & low).astype(np.uint16)] - r * (t - b + 1)
            least = np.minimum.reduceat(score, starts)
            hit = np.flatnonzero(score == least[group])
            first = hit[np.searchsorted(hit, starts)]  # ties: the least shingle
            chosen = tb.mix(key[first] ^ (t[first].astype(np.int64).astype(np.uint64) * tb.U64(0x9E3779B97F4A7C15)))
            band = h // ROWS
            bands[:, band] = tb.mix(bands[:, band] * tb.U64(31) + chosen + tb.U64(band))
        return doc[starts], bands


def _weights(key: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return tf.astype(np.float32) * idf[(key % DF_BUCKETS).astype(np.int64)]


def signatures(docs: DataFrame, keep: list[str], idf, text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``bands`` (null for a text without a word)."""
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = rows.drop("_text").schema.add("bands", ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            for part in tb.slices(batch, len(keep), 1_000_000):
                doc, key, tf = shingles(part.column(len(keep)))
                sizes = np.zeros(part.num_rows + 1, np.int32)
                flat = np.zeros(0, np.int64)
                if len(doc):
                    has, bands = sampler.sample(doc, key, _weights(key, tf, idf.value))
                    sizes[has + 1] = BANDS
                    flat = bands.view(np.int64).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(flat),
                                                 mask=pa.array(sizes[1:] == 0))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], names=[*part.schema.names[:-1], "bands"])
        tb.release()

    return rows.mapInArrow(run, schema)


def overlaps(left: pa.Array, right: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared weight and sum of both total weights of each pair of whole texts."""
    n = len(left)
    doc, key, weight = [], [], []
    for texts in (left, right):
        d, s, tf = shingles(texts)
        doc.append(d)
        key.append(s)
        weight.append(_weights(s, tf, idf).astype(np.float64))
    doc, key, weight = map(np.concatenate, (doc, key, weight))
    order = np.argsort((doc.astype(np.uint64) << KEY_BITS) | key, kind="stable")  # two sorted runs
    doc, key, weight = doc[order], key[order], weight[order]
    both = (doc[1:] == doc[:-1]) & (key[1:] == key[:-1])
    shared = np.bincount(doc[1:][both], np.minimum(weight[1:], weight[:-1])[both], minlength=n)[:n]
    return shared, np.bincount(doc, weight, minlength=n)[:n]


def weighted_jaccard(left: pa.Array, right: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Of each pair of whole texts; 0 where one has no word."""
    shared, totals = overlaps(left, right, idf)
    return np.divide(shared, totals - shared, out=np.zeros(len(shared)), where=totals > shared)


def _compared(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """The pairs (``a``, ``b``) with their ``shared`` weight and whether their
    weighted Jaccard reaches the threshold (``near``)."""
    full = (pairs.hint("merge").join(texts.select(F.col("t").alias("a"), F.col("text").alias("ta")), "a")
            .hint("merge").join(texts.select(F.col("t").alias("b"), F.col("text").alias("tb")), "b")
            .select("a", "b", "ta", "tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, 2, 4_000_000):
                shared, totals = overlaps(part.column(2), part.column(3), idf.value)
                near = np.divide(shared, totals - shared, out=np.zeros(len(shared)), where=totals > shared) >= threshold
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(shared), pa.array(near)],
                                                 names=["a", "b", "shared", "near"])
        tb.release()

    return full.mapInArrow(run, "a string, b string, shared double, near boolean")


def _members(classes: DataFrame) -> DataFrame:
    """(``band``, ``t``, ``small``, ``leader``) of every bucket that several
    texts share; the leader is its least text."""
    bands = stage(classes.select("t", F.explode("bands").alias("band")), "bands")
    size = stage(bands.groupBy("band").agg(F.count("*").alias("n"), F.min("t").alias("leader")).filter("n > 1"), "band-sizes")
    members = stage(bands.join(size, "band").select("band", "t", (F.col("n") <= SMALL).alias("small"), "leader"), "band-members")
    discard(bands, size)
    return members


def _rarest(texts: DataFrame, idf, threshold: float) -> DataFrame:
    """(``band``, ``t``, ``rest``, ``total``, ``common``): buckets of texts by
    their rarest shingles, such that any two texts that link share one.

    All shingles are ordered by how many of ``texts`` have them; ``rest`` is
    the weight of a text's shingles from the one of the bucket on, ``total``
    that of all, ``common`` that of those which another text has too.  Linked
    texts share at least threshold / (1 + threshold) x (the sum of their
    totals), all of it from their first common shingle on, so both have that
    much left there.  A text's partner weighs between threshold and
    1 / threshold times as much; a bucket is for two classes of totals, which
    bounds the sum from below.  What many texts share comes last and is hardly
    ever in a bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, 1, 1_000_000):
                doc, key, tf = shingles(part.column(1))
                weight = _weights(key, tf, idf.value).astype(np.float64)
                total = np.bincount(doc, weight, minlength=part.num_rows)[doc]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), pa.array(key.view(np.int64)), pa.array(weight), pa.array(total)],
                    names=["t", "shingle", "weight", "total"])
        tb.release()

    rows = stage(texts.select("t", "text").mapInArrow(run, "t string, shingle long, weight double, total double"), "open-shingles")
    often = stage(rows.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1"), "shared-shingles")
    back = Window.partitionBy("t").orderBy(F.desc("n"), F.desc("shingle")).rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.hint("merge").join(often, "shingle").withColumn("rest", F.sum("weight").over(back))
              .withColumn("common", F.sum("weight").over(Window.partitionBy("t")))
              .filter(F.col("rest") >= F.col("total") * (threshold * (1 - SLACK))))

    def class_of(total):
        return F.floor(F.log(total) / math.log(CLASS))

    low, total = threshold * (1 - SLACK), F.col("total")
    least = F.greatest(F.pow(F.lit(CLASS), F.col("other")), total * threshold)
    found = stage(placed.withColumn("own", class_of(total))
                  .withColumn("other", F.explode(F.sequence(class_of(total * low), class_of(total / low))))
                  .filter(_enough(F.col("rest"), total + least, threshold))
                  .select(F.xxhash64("shingle", F.least("own", "other"), F.greatest("own", "other")).alias("band"),
                          "t", "rest", "total", "common"), "rare-shingles")
    discard(rows, often)
    return found


def _enough(shared, totals, threshold: float):
    """May texts that share at most so much link?"""
    return shared >= totals * (threshold / (1 + threshold) * (1 - SLACK))


class _Links:
    """Links found so far, their components, and what pairs are compared with."""

    def __init__(self, texts: DataFrame, idf, threshold: float):
        self.texts, self.idf, self.threshold = texts, idf, threshold
        self._stars: DataFrame | None = None  # of what was linked when last asked
        self._new: list[DataFrame] = []  # links (u, v) since then

    def check(self, candidates: DataFrame) -> DataFrame:
        """Compare candidates (``t``, ``leader``), keep those that link; all of
        them with their shared weight."""
        pairs = candidates.select(F.least("t", "leader").alias("a"), F.greatest("t", "leader").alias("b")).distinct()
        done = stage(_compared(pairs, self.texts, self.idf, self.threshold), "compared-pairs")
        near = done.filter("near").select(F.col("b").alias("u"), F.col("a").alias("v"))
        if (self._stars is None and not self._new) or not near.isEmpty():
            self._new.append(near)
        return done

    def roots(self) -> DataFrame:
        """(``node``, ``root``) of the texts whose component has a lesser one."""
        if self._new:
            known = [self._stars] if self._stars is not None else []
            self._stars, self._new = stars(reduce(DataFrame.unionByName, known + self._new)), []
        return self._stars.select(F.col("u").alias("node"), F.col("v").alias("root"))

    def open(self, rows: DataFrame) -> DataFrame:
        """``rows`` (``band``, ``t``, ...) of buckets that hold several
        components, with the ``root`` of ``t``."""
        known = rows.join(self.roots().withColumnRenamed("node", "t"), "t", "left").withColumn("root", F.coalesce("root", "t"))
        bands = known.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
        return stage(known.join(bands.select("band"), "band"), "open-buckets")


def _to_the_end(members: DataFrame, links: _Links) -> None:
    """Buckets of bounded size (``band``, ``t``): members meet all members of
    other components."""
    rows = links.open(members)
    other = rows.select("band", F.col("root").alias("other_root"), F.col("t").alias("leader"))
    links.check(rows.join(other, "band").filter((F.col("root") != F.col("other_root")) & (F.col("t") < F.col("leader")))
                .select("t", "leader"))
    discard(rows)


def _by_rarest(rows: DataFrame, links: _Links) -> None:
    """Buckets of any size (see ``_rarest``).

    Every member meets the bucket's most central text first, the one with the
    least that no other text has: copies of one original with edits of their
    own mostly link to it.  Then pairs of different components meet, as far as
    their weights allow a link: what two texts share is at most what one
    shares with the leader plus what the other, besides that with the leader,
    shares with anybody.  Texts that missed the leader hardly pass that.
    """
    threshold = links.threshold
    first = links.open(rows)
    central = stage(first.groupBy("band").agg(F.max(F.struct((F.col("common") / F.col("total")).alias("c"), "t")).alias("x"))
                    .select("band", F.col("x.t").alias("leader")), "central-texts")
    led = stage(first.drop("root").join(central, "band"), "led-texts")
    met = links.check(led.filter("t <> leader").select("t", "leader"))
    shared = met.select(F.col("a").alias("t"), F.col("b").alias("leader"), "shared").unionByName(
        met.select(F.col("b").alias("t"), F.col("a").alias("leader"), "shared"))
    known = stage(led.join(shared, ["t", "leader"], "left").withColumn(
        "through", F.coalesce("shared", F.when(F.col("t") == F.col("leader"), F.col("total"))))
        .select("band", "t", "rest", "total", "through", (F.col("common") - F.col("through")).alias("beside")), "rare-texts")
    left = links.open(known)
    other = left.select("band", *[F.col(c).alias(f"other_{c}") for c in ("t", "root", "rest", "total", "through", "beside")])
    at_most = F.least("rest", "other_rest", F.col("through") + F.greatest(F.lit(0.0), "other_beside"),
                      F.col("other_through") + F.greatest(F.lit(0.0), "beside"))
    links.check(left.join(other, "band").filter(
        (F.col("t") < F.col("other_t")) & (F.col("root") != F.col("other_root"))
        & _enough(at_most, F.col("total") + F.col("other_total"), threshold)).select("t", F.col("other_t").alias("leader")))
    discard(first, central, led, known, left)


def _links(members: DataFrame, texts: DataFrame, idf, threshold: float) -> _Links:
    """Links between texts, enough to hold every component together."""
    links = _Links(texts, idf, threshold)
    links.check(members.filter("t <> leader"))
    _to_the_end(members.filter("small").select("band", "t"), links)
    rest = stage(links.open(members.filter("not small").select("band", "t")).select("t").distinct(), "open-texts")
    if not rest.isEmpty():
        rare = _rarest(texts.join(rest.hint("merge"), "t", "left_semi"), idf, threshold)
        _by_rarest(rare, links)
        discard(rare)
    discard(rest)
    return links


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``text_key`` (md5 of the text),
    ``component_id`` (the least id of its group), ``n_members``, ``kept``.

    Two texts link if their weighted Jaccard similarity is at least
    ``threshold`` and they share a band (a pair at 0.8 misses all bands with
    probability 0.001; texts of large buckets may link without a band).  Null and empty texts and texts without a word link
    with nothing, not even with each other: own group, kept.  Null ids rank
    last; a group of null ids only has a null ``component_id`` and is kept.
    Rows repeated with id and text get the same verdict; see ``deduplicated``.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.md5(text).alias("t"))
    idf = spark.sparkContext.broadcast(document_frequency(rows))
    signed = stage(signatures(rows, ["id", "t"], idf), "signatures")
    classes = stage(signed.filter("bands is not null").groupBy("t").agg(
        F.min(F.coalesce("id", F.lit(LAST))).alias("id"), F.count("*").alias("n"), F.first("bands").alias("bands")), "text-classes")
    members = _members(classes)
    # one row of each text to compare: copies differ in the id, so none is hot.
    # What grows with the input is merged at any size, never broadcast
    wanted = stage(members.select("t").distinct().join(classes.select("t", "id"), "t"), "texts-to-compare")
    texts = stage(rows.select("t", F.coalesce("id", F.lit(LAST)).alias("id"), "text")
                  .join(wanted.hint("merge"), ["t", "id"], "left_semi").dropDuplicates(["t", "id"]).select("t", "text"), "texts")
    links = _links(members, texts, idf, threshold)
    root = classes.select("t", "id", "n")
    known = links.roots().withColumnRenamed("node", "t")
    root = stage(root.join(known, "t", "left").select("t", "id", "n", F.coalesce("root", "t").alias("root")), "text-roots")
    groups = root.groupBy("root").agg(F.min("id").alias("least"), F.sum("n").alias("n_members"))
    # of texts that share the least id the one with the least key stays
    stays = (root.join(groups, "root").filter("id = least").groupBy("root")
             .agg(F.first("least").alias("least"), F.first("n_members").alias("n_members"), F.min("t").alias("stay")))
    verdict = stage(root.join(stays, "root").select("t", "least", "n_members", "stay"), "text-verdicts")
    judged = signed.drop("bands").join(verdict, "t", "left")
    rank = F.coalesce("id", F.lit(LAST))
    return judged.select(
        F.col("id").alias(id_col), F.col("t").alias("text_key"),
        F.when(F.col("least").isNull(), F.col("id")).when(F.col("least") < LAST, F.col("least")).alias("component_id"),
        F.coalesce("n_members", F.lit(1).cast("long")).alias("n_members"),
        F.coalesce((rank == F.col("least")) & (F.col("t") == F.col("stay")), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with one document of each group: the one with the least id
    (of rows repeated with id and text, one)."""
    own_id, own_key = free_name(docs.columns, "_id"), free_name(docs.columns, "_key")
    gone = near_duplicates(docs, id_col=id_col, text_col=text_col, **params).filter(~F.col("kept")).select(
        F.coalesce(F.col(id_col), F.lit(LAST)).alias(own_id), F.col("text_key").alias(own_key)).distinct()
    named = docs.withColumns({own_id: F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)),
                              own_key: F.md5(F.coalesce(F.col(text_col), F.lit("")))})
    return (named.join(stage(gone, "near-copies"), [own_id, own_key], "left_anti")
            .dropDuplicates([own_id, own_key]).select(*docs.columns))
