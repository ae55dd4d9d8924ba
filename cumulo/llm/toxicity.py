"""Toxicity: a convolutional text classifier in numpy, fitted on Spark.

Words (lower-cased tokens) and their stems are hashed to embedding rows; filters of several
widths slide over the embedded words, the maximum of each filter over the
whole text goes through a logistic layer.  Every labelled row is learnt from,
with its whole text.  Rows are dealt into shards by their ids; a round of the
fit takes every shard a number of epochs further from the same parameters, and
the shards' changes are averaged (of an embedding row, over the shards that
changed it).  Words that few labelled rows have keep a zero embedding, so an
unseen word cannot raise a score.

Two more networks, each fitted on one half of the rows, judge the other half:
their scores, one for every labelled row, give the temperature and a decision
threshold per language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.llm import textbuf as tb
from cumulo.llm.common import discard, stage
from cumulo.operators.joins import BLOOM
from cumulo.plans.inspect import session_conf

#: Words and stems in fewer labelled documents keep a zero embedding: they
#: would only let the network remember single documents.
MIN_DOCS = 4
#: Tokens whose filter responses are held at once (one longer document is alone).
CHUNK_TOKENS = 50_000
#: Documents of a step of the fit whose responses are held at once.
CHUNK_DOCS = 8
#: Bytes of a token that make its stem.
STEM = 4
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 18, 8, (1, 2, 3), 24
#: Bytes of text of a shard, the unit a task learns from.
SHARD_BYTES = 24_000_000
#: Rounds of the fit where there are several shards (about); epochs and documents seen at least.
ROUNDS, EPOCHS, VISITS = 6, 6, 102_400
#: Rows of each class that a language needs for a threshold of its own.
LEAST_ROWS = 30
#: Changes of parameters and of their past are added up as whole numbers of these
#: parts of one, so that sums don't depend on their order.
UNITS = np.array([2.0**24, 2.0**36])
#: Temperatures and thresholds that are tried.
TEMPERATURES = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
THRESHOLDS = np.linspace(0.02, 0.98, 49)


def token_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(embedding rows of every token: its own and its stem's; offsets by document)."""
    data, offs = tb.buffer(texts)
    data = tb.LOWER[data]
    s, e, doc = tb.tokens(data, offs)
    rolling = tb.Rolling(data)
    stem = tb.mix(rolling.of(s, np.minimum(e, s + STEM)) + tb.U64(1))
    ids = np.stack([rolling.of(s, e), stem], axis=1) % (BUCKETS - 1) + 1  # row 0: padding
    return ids.astype(np.int32), np.searchsorted(doc, np.arange(len(offs)))


def padded(ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents one after another with enough padding between them that no
    filter sees two; (ids, start of each document)."""
    gap = max(WIDTHS)
    n = len(offs) - 1
    starts = offs[:-1] + gap * np.arange(n)
    out = np.zeros((len(ids) + gap * n, 2), np.int32)
    out[np.arange(len(ids)) + gap * np.repeat(np.arange(n), np.diff(offs))] = ids
    return out, starts


class Cnn:
    def __init__(self, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.rng = rng
        self.table = rng.normal(0, 0.3, (BUCKETS, DIM)).astype(np.float32)
        self.table[0] = 0
        self.filters = [rng.normal(0, 0.5 / np.sqrt(w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, len(WIDTHS) * FILTERS)
        self.bias = np.zeros(1)
        self.temperature = 1.0
        self.place = None  # where a bucket's row is in the table, if not all are there
        self.past = {name: np.full(value.shape, 1e-8, value.dtype) for name, value in self.parts().items()}

    def parts(self) -> dict:
        """Parameters by name; ``past`` has their summed squares of gradients."""
        return {"t": self.table, "o": self.out, "b": self.bias, **dict(zip(WIDTHS, self.filters))}

    def state(self) -> np.ndarray:
        """Parameters and their past, both as rows of DIM numbers: the embedding
        rows, then everything else."""
        done = []
        for parts in (self.parts(), self.past):
            rest = np.concatenate([parts[name].ravel() for name in (*WIDTHS, "o", "b")])
            done.append(np.concatenate([parts["t"], np.append(rest, np.zeros(-len(rest) % DIM)).reshape(-1, DIM)]))
        return np.array(done, np.float32)

    def only(self, rows: np.ndarray) -> Cnn:
        """Itself with the embedding ``rows`` alone, behind row 0; others are zero."""
        self.place = np.zeros(BUCKETS, np.int32)
        self.place[rows] = np.arange(1, len(rows) + 1)
        at = np.append(0, rows)
        self.table, self.past["t"] = self.table[at], self.past["t"][at]
        return self

    def at(self, state: np.ndarray) -> Cnn:
        """Itself with the parameters and the past of ``state``."""
        for parts, values in zip((self.parts(), self.past), state):
            parts["t"][:] = values[:len(self.table)]
            rest = values[len(self.table):].ravel()
            for name in (*WIDTHS, "o", "b"):
                parts[name][...] = rest[:parts[name].size].reshape(parts[name].shape)
                rest = rest[parts[name].size:]
        return self

    def embed(self, ids: np.ndarray) -> np.ndarray:
        out = self.table.take(ids[:, 0], axis=0)
        out += self.table.take(ids[:, 1], axis=0)
        return out

    def maps(self, embedded: np.ndarray) -> np.ndarray:
        """Responses of every filter, by width, at every position: a row of
        each filter, so that maxima run along memory."""
        n, most = len(embedded), max(WIDTHS)
        near = np.zeros((most, DIM, n), np.float32)  # what stands j places further
        near[0] = embedded.T
        for j in range(1, most):
            near[j, :, :-j] = near[0, :, j:]
        result = np.empty((len(WIDTHS) * FILTERS, n), np.float32)
        for k, (w, weight) in enumerate(zip(WIDTHS, self.filters)):
            np.matmul(weight.reshape(w * DIM, FILTERS).T, near[:w].reshape(w * DIM, n), out=result[k * FILTERS:(k + 1) * FILTERS])
        return result

    def logits(self, ids: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Of each document, some at a time so that the maps stay small."""
        out = np.zeros(len(offs) - 1)
        begin = 0
        while begin < len(out):
            end = max(begin + 1, int(np.searchsorted(offs, offs[begin] + CHUNK_TOKENS, "right")) - 1)
            some = ids[offs[begin]:offs[end]]
            out[begin:end] = self._logits(some if self.place is None else self.place[some], offs[begin:end + 1] - offs[begin])
            begin = end
        return out

    def _logits(self, ids: np.ndarray, offs: np.ndarray) -> np.ndarray:
        sizes = np.diff(offs)
        ids, starts = padded(ids, offs)
        # a document's places and the first of its padding; filters there see
        # no token of the next document
        bounds = np.stack([starts, starts + sizes + 1], axis=1).ravel()
        most = np.maximum.reduceat(self.maps(self.embed(ids)), bounds, axis=1)[:, ::2]
        return np.maximum(most.T, 0) @ self.out + self.bias

    def probability(self, ids, offs) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(ids, offs) / self.temperature, -60, 60)))

    def fit(self, docs: list[np.ndarray], y: np.ndarray, epochs: int, rng: np.random.Generator,
            batch: int = 64, rate: float = 0.05) -> Cnn:
        """Adagrad on the log loss over documents of buckets; only embedding
        rows under a maximum change."""
        parts, past = self.parts(), self.past

        def step(name, grad, at=slice(None)):
            past[name][at] += grad * grad
            parts[name][at] -= (rate * grad / np.sqrt(past[name][at])).astype(parts[name].dtype)

        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for i in range(0, len(order), batch):
                rows = order[i:i + batch]
                ids, starts = padded(np.concatenate([docs[r] for r in rows]),
                                     np.cumsum([0, *[len(docs[r]) for r in rows]]))
                ends = starts + [len(docs[r]) + 1 for r in rows]
                if self.place is not None:
                    ids = self.place[ids]
                embedded = self.embed(ids)
                at, tops = [], []
                for k in range(0, len(rows), CHUNK_DOCS):
                    low = starts[k]  # behind the last of these documents is padding
                    maps = self.maps(embedded[low:ends[min(k + CHUNK_DOCS, len(rows)) - 1]])
                    for s, e in zip(starts[k:k + CHUNK_DOCS], ends[k:k + CHUNK_DOCS]):
                        top = maps[:, s - low:e - low].argmax(1) + (s - low)
                        at.append(top + low)
                        tops.append(maps[np.arange(len(maps)), top])
                at, hidden = np.array(at), np.maximum(np.array(tops), 0)
                err = (1 / (1 + np.exp(-(hidden @ self.out + self.bias))) - y[rows]) / len(rows)
                back = np.outer(err, self.out) * (hidden > 0)
                touched, grads = [], []
                for k, (w, weight) in enumerate(zip(WIDTHS, self.filters)):
                    g = back[:, k * FILTERS:(k + 1) * FILTERS].astype(np.float32)
                    grad = np.zeros_like(weight)
                    for j in range(w):
                        pos = np.minimum(at[:, k * FILTERS:(k + 1) * FILTERS] + j, len(ids) - 1)
                        grad[j] = np.einsum("df,dfe->ef", g, embedded[pos])
                        grad_in = (g[:, :, None] * weight[j].T[None]).reshape(-1, DIM)
                        for part in (0, 1):
                            touched.append(ids[pos, part].ravel())
                            grads.append(grad_in)
                    step(w, grad)
                rows_at, inverse = np.unique(np.concatenate(touched), return_inverse=True)
                total = np.stack([np.bincount(inverse, g) for g in np.concatenate(grads).T], axis=1).astype(np.float32)
                total[rows_at == 0] = 0  # padding stays zero
                step("t", total, rows_at)
                step("o", hidden.T @ err)
                step("b", err.sum(keepdims=True))
        return self


def language_thresholds(p: np.ndarray, y: np.ndarray, langs: np.ndarray, n=1) -> dict[str, float]:
    """The cut of every language with LEAST_ROWS rows of each class; others take
    the common one.  ``n``: see ``best_threshold``."""
    own = {}
    n = np.broadcast_to(n, y.shape)
    for k in sorted(set(langs.tolist())):
        mine = langs == k
        if k and min(y[mine].sum(), (n - y)[mine].sum()) >= LEAST_ROWS:
            own[k] = best_threshold(p[mine], y[mine], n[mine])
    return own


def best_threshold(p: np.ndarray, y: np.ndarray, n=1) -> float:
    """The cut of the best F1 (0.5 if there is no positive row); each entry
    stands for ``n`` rows, of which ``y`` are positive."""
    if not y.any():
        return 0.5
    hit = np.array([y[p >= t].sum() for t in THRESHOLDS])
    called = np.array([((p >= t) * n).sum() for t in THRESHOLDS])
    f1 = 2 * hit / np.maximum(called + y.sum(), 1)
    return float(THRESHOLDS[np.flatnonzero(f1 == f1.max())].mean())


# --- the fit on Spark ---------------------------------------------------------

_SHARD = "shard int, ids binary, offs binary, label binary, half binary, lang array<string>"
#: Of the three networks, the last is the one that scores.
_LEARNS = (lambda half: half == 0, lambda half: half == 1, lambda half: half >= 0)


def labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(``_id``, ``_lang``, ``_text``, ``label``, ``half``) of every labelled id,
    one row of each: the one of least text's hash."""
    known = known.select(F.col("doc_id").alias("_id"), "label")
    row = F.struct(F.xxhash64("_text"), "_text", "_lang", "label")
    # labels grow with the input: never broadcast, but few texts without one are shuffled
    found = docs.join(known.hint("merge"), "_id").groupBy("_id").agg(F.min(row).alias("x"))
    with session_conf(docs.sparkSession, **BLOOM):
        return stage(found.select("_id", "x._lang", "x._text", "x.label", F.pmod(F.xxhash64("_id", F.lit(23)), F.lit(2)).cast("int").alias("half")),
                     "toxicity-labelled")


def sharded(rows: DataFrame, shards: int) -> DataFrame:
    """A row of each shard: its texts' tokens, labels, halves and languages, by id."""

    def run(table: pa.Table) -> pa.Table:
        table = table.take(pa.compute.sort_indices(table, sort_keys=[("_id", "ascending")]))
        ids, offs = [], [np.zeros(1, np.int64)]
        for batch in table.select(["_text"]).to_batches():
            for part in tb.slices(batch, 0):
                new, at = token_ids(part.column(0))
                ids.append(new)
                offs.append(at[1:] + offs[-1][-1])
        label, half = (np.asarray(table.column(c)).astype(np.int8) for c in ("label", "half"))
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in (np.concatenate(ids), np.concatenate(offs).astype(np.int64), label, half)]
        done = pa.table([table.column("shard").combine_chunks()[:1], *blobs, pa.array([table.column("_lang").to_pylist()], pa.list_(pa.string()))],
                        names=["shard", "ids", "offs", "label", "half", "lang"])
        tb.release()
        return done

    shard = F.pmod(F.xxhash64("_id"), F.lit(shards)).cast("int").alias("shard")
    dealt = rows.select(shard, "_id", "_lang", "_text", "label", "half").repartition(2 * shards, "shard")
    return stage(dealt.groupBy("shard").applyInArrow(run, _SHARD), "toxicity-shards")


def _opened(batches: Iterator[pa.RecordBatch]):
    """(shard, tokens, offsets, labels, halves, languages) of every row."""
    for batch in batches:
        for i in range(batch.num_rows):
            shard, ids, offs, label, half, lang = (batch.column(c)[i] for c in range(6))
            yield (shard.as_py(), np.frombuffer(ids.as_buffer(), np.int32).reshape(-1, 2), np.frombuffer(offs.as_buffer(), np.int64),
                   np.frombuffer(label.as_buffer(), np.int8), np.frombuffer(half.as_buffer(), np.int8), lang.as_py())


def known_rows(shards: DataFrame) -> list[np.ndarray]:
    """For each network the embedding rows of words and stems that MIN_DOCS of
    the documents it learns from have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int64)
        for _, ids, offs, _, half, _ in _opened(batches):
            for a, b, h in zip(offs, offs[1:], half):
                seen[h, np.unique(ids[a:b])] += 1
        at = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[0, at]), pa.array(seen[1, at])], names=["row", "n0", "n1"])

    counts = (shards.mapInArrow(run, "row int, n0 long, n1 long").groupBy("row").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
              .filter(F.col("n0") + F.col("n1") >= MIN_DOCS).toArrow())  # BUCKETS rows at most
    row, n0, n1 = (np.asarray(counts.column(c).combine_chunks()) for c in ("row", "n0", "n1"))
    return [np.sort(row[n >= MIN_DOCS]) for n in (n0, n1, n0 + n1)]


def _round(shards: DataFrame, k: int, shared, epochs: int, nth: int) -> DataFrame:
    """Changes of network ``k`` by every shard, from the (embedding rows, state)
    that are ``shared``: ``net``, ``row``, ``v0..`` of its parameters and of
    their past, in UNITS."""
    names = [f"v{i}" for i in range(2 * DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Cnn().only(shared.value[0])
        state = shared.value[1]
        for shard, ids, offs, label, half, _ in _opened(batches):
            mine = np.flatnonzero(_LEARNS[k](half))
            if len(mine):
                docs = [ids[offs[i]:offs[i + 1]] for i in mine]
                net.at(state).fit(docs, label[mine].astype(float), epochs, np.random.default_rng([17, k, nth, shard]))
                change = net.state()
                change -= net.at(state).state()
                at = np.flatnonzero(change[1].any(1))
                units = np.rint(change[:, at] * UNITS[:, None, None]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)),
                     *[pa.array(np.ascontiguousarray(part[:, i])) for part in units for i in range(DIM)]], names=["net", "row", *names])
        tb.release()

    return shards.mapInArrow(run, "net int, row int, " + ", ".join(f"{c} long" for c in names))


def fitted(shards: DataFrame, n_shards: int, halves: dict[int, tuple[int, int]]) -> list[Cnn | None]:
    """The networks of the halves and of all rows; None where a class lacks.
    ``halves``: (rows, positive ones) of each."""
    sizes = [np.array(halves.get(h, (0, 0))) for h in (0, 1)]
    sizes.append(sizes[0] + sizes[1])
    context = shards.sparkSession.sparkContext
    rows = known_rows(shards)
    states = {k: Cnn().only(rows[k]).state() for k, (n, ones) in enumerate(sizes) if 0 < ones < n}
    epochs = {k: max(EPOCHS, -(-VISITS // int(sizes[k][0]))) for k in states}
    each = {k: -(-n // ROUNDS) if n_shards > 1 else n for k, n in epochs.items()}  # in a round
    for nth in range(max(-(-epochs[k] // each[k]) for k in states)):
        # BUCKETS rows at most; destroyed after the round, as every process has them on its disk
        shared = {k: context.broadcast((rows[k], state)) for k, state in states.items() if nth * each[k] < epochs[k]}
        parts = [_round(shards, k, own, each[k], nth) for k, own in shared.items()]
        every = parts.pop()
        while parts:
            every = every.unionByName(parts.pop())
        means = [(F.sum(f"v{i}") / F.count("*") / float(UNITS[i // DIM])).cast("float").alias(f"v{i}") for i in range(2 * DIM)]
        step = stage(every.groupBy("net", "row").agg(*means), "toxicity-round")
        got = step.toArrow()  # a row of each of the networks' rows at most
        net, row = (np.asarray(got.column(c).combine_chunks()) for c in ("net", "row"))
        for k in shared:
            mine = net == k
            for i in range(2 * DIM):
                states[k][i // DIM, row[mine], i % DIM] += np.asarray(got.column(f"v{i}").combine_chunks())[mine]
            shared[k].destroy()
        del every, got
        discard(step)
    return [Cnn().only(rows[k]).at(states[k]) if k in states else None for k in range(3)]


def judged(shards: DataFrame, nets: list[Cnn]) -> DataFrame:
    """(``lang``, ``y``, ``logit``) of every labelled row, by the network of the
    other half."""
    shared = shards.sparkSession.sparkContext.broadcast(nets[:2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, offs, label, half, lang in _opened(batches):
            logits = np.where(half == 1, shared.value[0].logits(ids, offs), shared.value[1].logits(ids, offs))
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(label.astype(np.int32)), pa.array(logits)], names=["lang", "y", "logit"])
        tb.release()

    return stage(shards.mapInArrow(run, "lang string, y int, logit double"), "toxicity-judged")


def temperature_of(rows: DataFrame) -> float:
    """The temperature of least log loss over all of ``judged``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, logit = (np.asarray(batch.column(c)) for c in ("y", "logit"))
            z = logit[:, None] / TEMPERATURES
            loss = np.rint((np.logaddexp(0, z) - y[:, None] * z) * 2.0**20).astype(np.int64).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(loss), dtype=np.int32)), pa.array(loss)], names=["nth", "loss"])

    loss = rows.mapInArrow(run, "nth int, loss long").groupBy("nth").agg(F.sum("loss").alias("loss"))
    return float(TEMPERATURES[loss.orderBy("loss", "nth").first()["nth"]])


def thresholds(rows: DataFrame, temperature: float) -> tuple[DataFrame, float]:
    """((``_lang``, ``own``) of the languages with a threshold of their own, the
    common one) over all of ``judged``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = 1 / (1 + np.exp(-np.clip(np.asarray(batch.column("logit")) / temperature, -60, 60)))
            cell = np.searchsorted(THRESHOLDS, p, "right")
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("y"), pa.array(np.append(0, THRESHOLDS)[cell])], names=["_lang", "y", "p"])

    counts = stage(rows.mapInArrow(run, "_lang string, y int, p double").groupBy("_lang", "p")
                   .agg(F.sum("y").alias("y"), F.count("*").alias("n")), "toxicity-counts")

    def own(table: pa.Table) -> pa.Table:
        p, y, n = (np.asarray(table.column(c)) for c in ("p", "y", "n"))
        found = language_thresholds(p, y, np.array(table.column("_lang").to_pylist()), n)
        return pa.table({"_lang": pa.array(list(found), pa.string()), "own": pa.array(list(found.values()), pa.float64())})

    every = counts.groupBy("p").agg(F.sum("y").alias("y"), F.sum("n").alias("n")).toArrow()  # a row of each threshold
    p, y, n = (np.asarray(every.column(c).combine_chunks()) for c in ("p", "y", "n"))
    cuts = stage(counts.filter("_lang is not null").groupBy("_lang").applyInArrow(own, "_lang string, own double"), "toxicity-thresholds")
    return cuts, best_threshold(p, y, n)


def score(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> DataFrame:
    """``id_col``, ``score`` (probability of label 1), ``threshold`` (the
    language's) and ``toxic`` of every whole text.

    ``known``: labelled ids (``doc_id``, ``label``), all learnt from.  The
    language picks the threshold only, never the score.  Null and empty texts
    score as a text without a word; null or new languages, and languages with
    few labelled rows, take the common threshold; repeated rows are scored
    each; of several rows of a labelled id one is learnt from.  Without
    labelled rows of both classes the score is the share of label 1 (0 without
    labels).
    """
    docs = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = docs.schema["_id"].dataType.simpleString()
    rows = labelled(docs, known)
    halves = {r["half"]: r for r in rows.groupBy("half").agg(
        F.count("*").alias("n"), F.sum("label").alias("ones"), F.sum(F.octet_length("_text")).alias("bytes")).collect()}
    total, ones = (sum(r[c] for r in halves.values()) for c in ("n", "ones"))
    net, own, other = None, None, 0.5
    if 0 < ones < total:
        n_shards = int(sum(r["bytes"] for r in halves.values()) // SHARD_BYTES) + 1
        shards = sharded(rows, n_shards)
        discard(rows)
        nets = fitted(shards, n_shards, {h: (r["n"], r["ones"]) for h, r in halves.items()})
        net = nets[2]
        if nets[0] and nets[1]:
            done = judged(shards, nets)
            net.temperature = temperature_of(done)
            own, other = thresholds(done, net.temperature)
        discard(shards)
    base = ones / total if total else 0.0
    if net:
        net.past = None
    shared = docs.sparkSession.sparkContext.broadcast(net)  # BUCKETS x DIM floats at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, 2, 4_000_000):
                p = (shared.value.probability(*token_ids(part.column(2))) if shared.value
                     else np.full(part.num_rows, base))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(p, pa.float64())], names=[id_col, "_lang", "score"])

    scored = docs.mapInArrow(run, f"`{id_col}` {kind}, _lang string, score double")
    cut = F.lit(other)
    if own is not None:
        scored = scored.join(own, "_lang", "left")  # Spark picks the join by the size of the written table
        cut = F.coalesce("own", F.lit(other))
    return scored.select(id_col, "score", cut.alias("threshold"), (F.col("score") >= cut).alias("toxic"))
