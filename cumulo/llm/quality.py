"""Quality classifier: random-indexing word vectors pooled per document, a
two-layer numpy network, and temperature-calibrated probabilities.

1. Every word (hashed to ``BUCKETS``) has a sparse random index vector.  One
   pass over all texts adds, for every word, the index vectors of the words
   up to two places away.  Tasks add up locally and emit one row per bucket,
   so the shuffle does not depend on how frequent a word is, and the summed
   table has a fixed size (BUCKETS x DIM integers), which is the only thing
   that is collected and broadcast.
2. A second pass pools the word vectors of each whole text (weighted mean and
   standard deviation).
3. The network is fitted on a bounded sample of labelled rows; a part of it
   is kept from the fit to find the temperature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from cumulo.llm import textbuf as tb
from cumulo.llm.common import stage

BUCKETS, DIM, NONZERO, WINDOW = 1 << 15, 32, 2, 2
FEATURES = 2 * DIM + 2
#: The bound on labelled rows the network is fitted on.
TRAIN_ROWS = 20_000


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(dimension, sign) of the nonzero entries of every bucket's index vector."""
    rng = np.random.default_rng(5)
    return rng.integers(0, DIM, (BUCKETS, NONZERO)), rng.choice([-1, 1], (BUCKETS, NONZERO))


def bucket_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(bucket of every token, its document, number of documents)."""
    data, offs = tb.buffer(texts)
    s, e, doc = tb.tokens(data, offs)
    return (tb.Rolling(data).of(s, e) % BUCKETS).astype(np.int64), doc, len(offs) - 1


def context_sums(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per word bucket: ``n`` tokens and the sums ``v0..`` of their neighbours'
    index vectors, over all documents."""
    cols = [f"v{i}" for i in range(DIM)]
    schema = "bucket int, n long, " + ", ".join(f"{c} long" for c in cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims, signs = index_vectors()
        count = np.zeros(BUCKETS, np.int64)
        sums = np.zeros(BUCKETS * DIM, np.int64)
        for batch in batches:
            for part in tb.slices(batch, 0):
                ids, doc, _ = bucket_ids(part.column(0))
                count += np.bincount(ids, minlength=BUCKETS)
                for gap in range(1, WINDOW + 1):
                    near = doc[gap:] == doc[:-gap]
                    left, right = ids[:-gap][near], ids[gap:][near]
                    for word, other in ((left, right), (right, left)):
                        for k in range(NONZERO):
                            sums += np.bincount(word * DIM + dims[other, k], weights=signs[other, k],
                                                minlength=BUCKETS * DIM).astype(np.int64)
        seen = np.flatnonzero(count)
        table = sums.reshape(BUCKETS, DIM)[seen]
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(count[seen]), *[pa.array(np.ascontiguousarray(table[:, i])) for i in range(DIM)]],
            names=["bucket", "n", *cols])

    return (docs.select(F.col(text_col)).mapInArrow(run, schema)
            .groupBy("bucket").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in cols]))


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """BUCKETS x (DIM + 1) floats: unit word vectors and pooling weights."""
    # BUCKETS rows at most, in one order, so that sums agree on every run
    rows = context_sums(docs, text_col).toPandas().sort_values("bucket")
    out = np.zeros((BUCKETS, DIM + 1), np.float32)
    if len(rows):
        n = rows["n"].to_numpy(float)
        mean = rows.iloc[:, 2:].to_numpy(float) / n[:, None]
        mean -= (mean * n[:, None]).sum(0) / n.sum()  # what all words share
        mean /= np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-9)
        at = rows["bucket"].to_numpy()
        out[at, :DIM] = mean
        out[at, DIM] = 1e-3 / (1e-3 + n / n.sum())  # frequent words weigh less
    return out


def pool(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Documents x features: weighted mean and standard deviation of the word
    vectors, their mean weight, and the mean cosine of neighbouring words;
    zeros for a text without a word."""
    ids, doc, n = bucket_ids(texts)
    out = np.zeros((n, FEATURES), np.float32)
    if len(ids):
        starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        weight = vectors[ids, DIM]
        vec = vectors[ids, :DIM]
        total = np.add.reduceat(weight, starts, dtype=np.float64)[:, None]
        mean = np.add.reduceat(vec * weight[:, None], starts, axis=0) / total
        square = np.add.reduceat(vec * vec * weight[:, None], starts, axis=0) / total
        size = np.diff(np.append(starts, len(ids)))[:, None]
        alike = np.einsum("ij,ij->i", vec[:-1], vec[1:])
        alike = np.append(np.where(doc[1:] == doc[:-1], alike, 0), 0)
        alike = np.add.reduceat(alike, starts)[:, None] / np.maximum(size - 1, 1)
        out[doc[starts]] = np.hstack([mean, np.sqrt(np.maximum(square - mean * mean, 0)), total / size, alike])
    return out


class Network:
    """Two layers (tanh, sigmoid), fitted by Adam on standardised features."""

    def __init__(self, hidden: int = 32, seed: int = 3):
        self.hidden, self.seed, self.temperature = hidden, seed, 1.0

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 3e-3) -> Network:
        rng = np.random.default_rng(self.seed)
        x = x.astype(np.float64)
        self.mean, self.std = x.mean(0), x.std(0) + 1e-6
        held = rng.random(len(x)) < 0.2
        if held.all() or len(set(y[~held])) < 2:
            held[:] = False
        z, t = self.scaled(x[~held]), y[~held].astype(float)
        d = z.shape[1]
        p = self.params = [rng.normal(0, 1 / np.sqrt(d), (d, self.hidden)), np.zeros(self.hidden),
                           rng.normal(0, 1 / np.sqrt(self.hidden), self.hidden), np.zeros(1)]
        m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(z))
            for i in range(0, len(z), batch):
                b = order[i:i + batch]
                h = np.tanh(z[b] @ p[0] + p[1])
                err = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - t[b]) / len(b)
                back = np.outer(err, p[2]) * (1 - h * h)
                step += 1
                for k, g in enumerate((z[b].T @ back + 1e-4 * p[0], back.sum(0), h.T @ err, err.sum(keepdims=True))):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        if held.any():
            self.temperature = temperature(self.logits(x[held]), y[held])
        return self

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.std, -8, 8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.params
        return np.tanh(self.scaled(x) @ a + b) @ c + d

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on rows kept from the fit."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    z = logits[:, None] / grid
    loss = np.mean(np.logaddexp(0, z) - y[:, None] * z, axis=0)
    return float(grid[int(np.argmin(loss))])


def features(docs: DataFrame, keep: list[str], vectors: np.ndarray, text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``features`` (array of float) of every whole text."""
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = rows.drop("_text").schema.add("features", ArrayType(FloatType()))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, len(keep)):
                x = pool(part.column(len(keep)), shared.value)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists],
                                                 names=[*part.schema.names[:-1], "features"])
        tb.release()

    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` (probability of label 1) of every document.

    ``sample``: bounded labelled rows (``doc_id``, ``label``) to learn from,
    see ``labels.sample``.  Null and empty texts have zero features and the
    score the network gives those; ids play no part in a score; repeated rows
    are scored each; of several rows of a labelled id one is learnt from.  With no labelled row of both classes the score is the
    share of label 1 (0.5 without labels).
    """
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    pooled = stage(features(docs, ["_id"], word_vectors(docs, "_text"), "_text"), "quality-features")
    train = (pooled.join(F.broadcast(sample.select(F.col("doc_id").alias("_id"), "label")), "_id")
             # one row of an id, the one of least features: at most TRAIN_ROWS rows
             .groupBy("_id").agg(F.min(F.struct(F.xxhash64("features"), "features", "label")).alias("x"))
             .select("_id", "x.features", "x.label").toPandas().sort_values(["_id"], kind="stable"))
    y = train["label"].to_numpy()
    if len(set(y)) > 1:
        net = Network().fit(np.array(train["features"].tolist(), np.float32), y)
    else:
        net = None
    base = float(y.mean()) if len(y) else 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            x = np.asarray(lists.flatten()).reshape(len(lists), -1) if len(lists) else np.zeros((0, FEATURES))
            p = net.probability(x) if net and len(x) else np.full(len(x), base)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=[id_col, "score"])

    kind = docs.schema["_id"].dataType.simpleString()
    return pooled.select("_id", "features").mapInArrow(run, f"`{id_col}` {kind}, score double")
