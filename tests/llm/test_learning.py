"""Classifiers: held-out accuracy and awkward rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulo.llm import labels, quality, toxicity
from cumulo.llm.queries import op3_quality, op5_toxicity
from tests.llm.helpers import frame

SF = "/root/testdata/sf0.1"


def held_out(spark, query, column):
    known = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(column).alias("y"))
    return query(spark, SF).filter("held_out").join(known.dropna(), "doc_id").toPandas()


def test_quality_on_held_out_documents(spark):
    got = held_out(spark, op3_quality, "quality")
    bad, good = got[got.y == 0], got[got.y == 1]
    assert (good.predicted == 1).mean() > 0.97 and (bad.predicted == 0).mean() > 0.8
    order = np.concatenate([bad.score, good.score]).argsort().argsort()
    auc = (order[len(bad):].mean() - order[:len(bad)].mean()) / len(got) + 0.5
    assert auc > 0.97


def test_toxicity_on_held_out_documents(spark):
    got = held_out(spark, op5_toxicity, "toxic")
    assert (got[got.y == 1].predicted == 1).mean() > 0.7 and (got[got.y == 0].predicted == 0).mean() > 0.95


@pytest.mark.parametrize("module", [quality, toxicity])
def test_awkward_rows_and_missing_labels(spark, module):
    docs = frame(spark)
    known = spark.createDataFrame([(100 + i, i % 2) for i in range(30)] + [(None, 1), (3, None)], "doc_id bigint, y int")
    some = labels.sample(known, "y", 5, 0, 20)
    got = module.score(docs, some).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    again = {(r["doc_id"], round(r["score"], 9)) for r in module.score(docs, some).collect()}
    assert again == {(r["doc_id"], round(r["score"], 9)) for r in got}  # reruns agree
    assert len({round(r["score"], 9) for r in got if r["doc_id"] in (10, 11, 12)}) == 1  # no words: one score
    none = module.score(docs, some.limit(0)).collect()
    assert len({round(r["score"], 9) for r in none}) == 1
    assert module.score(frame(spark, []), some).count() == 0


def test_sample_is_bounded_and_outside_the_fold(spark):
    known = spark.createDataFrame([(i, i % 2) for i in range(500)] + [(7, 1), (None, 0)], "doc_id bigint, y int")
    got = labels.sample(known, "y", 5, 0, 50).collect()
    assert len(got) == 50 and len({r["doc_id"] for r in got}) == 50
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in got)


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    z = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(int)
    assert quality.temperature(3 * z, y) == pytest.approx(3, rel=0.15)


def test_threshold_of_best_f1():
    p, y = np.array([0.1, 0.2, 0.6, 0.9]), np.array([0, 0, 1, 1])
    assert 0.2 < toxicity.best_threshold(p, y) <= 0.6
    assert toxicity.best_threshold(p, np.zeros(4, int)) == 0.5


def test_languages_with_few_rows_take_the_common_threshold():
    rng = np.random.default_rng(4)
    y = (rng.random(1000) < 0.3).astype(int)
    p = np.clip(y * 0.5 + rng.random(1000) * 0.6, 0, 1)
    langs = np.array(["en"] * 900 + ["fr"] * 98 + ["de"] * 2)
    y[900:998] = 0
    y[998:] = [0, 1]
    own = toxicity.language_thresholds(p, y, langs)
    assert set(own) == {"en"} and own["en"] == toxicity.best_threshold(p[:900], y[:900])


def test_repeated_labelled_ids_give_one_row(spark):
    """However many rows an id has, and in whatever order, one is learnt from."""
    docs = [(i, f"word{i % 7} text {i} " * 9, "en") for i in range(60)]
    more = [(3, f"other text {k} " * 5, "en") for k in range(200)]
    some = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, label int")
    for module in (quality, toxicity):
        a, b = (module.score(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(n), some).collect()
                for rows, n in ((docs + more, 3), (more[::-1] + docs[::-1], 5)))
        assert {(r["doc_id"], round(r["score"], 9)) for r in a} == {(r["doc_id"], round(r["score"], 9)) for r in b}


def test_convolution_against_plain_loops():
    import pyarrow as pa
    net = toxicity.Cnn()
    net.out += 0.3
    texts = ["", "one", "two words", "a b c d e f g", "x!? 12ab Ab " * 40, None]
    ids, offs = toxicity.token_ids(pa.array(texts))
    want = []
    for a, b in zip(offs, offs[1:]):
        doc = [net.table[i] + net.table[j] for i, j in ids[a:b]]
        hidden = []
        for w, weight in zip(toxicity.WIDTHS, net.filters):
            best = np.full(toxicity.FILTERS, 0.0)  # a place of padding alone is seen by every filter
            for at in range(len(doc)):
                r = sum((doc[at + j] @ weight[j] for j in range(w) if at + j < len(doc)), np.zeros(toxicity.FILTERS))
                best = np.maximum(best, r)
            hidden.append(np.maximum(best, 0))
        want.append(float(np.concatenate(hidden) @ net.out + net.bias[0]))
    assert np.allclose(net.logits(ids, offs), want, atol=1e-4)


def test_responses_of_a_filter_lie_in_a_row():
    """Maxima over a text run along memory; over columns they took most of the time."""
    rng = np.random.default_rng(4)
    net = toxicity.Cnn()
    embedded = rng.normal(size=(50, toxicity.DIM)).astype(np.float32)
    got = net.maps(embedded)
    assert got.shape == (len(toxicity.WIDTHS) * toxicity.FILTERS, 50) and got.flags.c_contiguous
    far = np.concatenate([embedded, np.zeros((max(toxicity.WIDTHS), toxicity.DIM))])  # nothing stands behind the end
    want = [sum(far[j:j + 50] @ weight[j, :, f] for j in range(w))
            for w, weight in zip(toxicity.WIDTHS, net.filters) for f in range(toxicity.FILTERS)]
    assert np.allclose(got, want, atol=1e-5)


def test_word_vectors_and_pooling_against_plain_loops(spark):
    import pyarrow as pa
    texts = ["a b c a b", "b", "", None, "c c c d", "a b c d e f g h i j"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    ids, doc, n = quality.bucket_ids(pa.array(texts))
    got = {r["bucket"]: r["n"] for r in quality.context_sums(docs).collect()}
    assert got == {int(b): int((ids == b).sum()) for b in set(ids.tolist())} and n == len(texts)
    vectors = quality.word_vectors(docs)
    x = quality.pool(pa.array(texts), vectors)
    for d in range(n):
        mine = [vectors[i] for i, k in zip(ids, doc) if k == d]
        if not mine:
            assert not x[d].any()
            continue
        weight = np.array([v[quality.DIM] for v in mine], float)
        vec = np.array([v[:quality.DIM] for v in mine], float)
        mean = (vec * weight[:, None]).sum(0) / weight.sum()
        spread = np.sqrt(np.maximum((vec * vec * weight[:, None]).sum(0) / weight.sum() - mean ** 2, 0))
        near = [float(a @ b) for a, b in zip(vec, vec[1:])]
        want = np.concatenate([mean, spread, [weight.mean(), sum(near) / max(len(mine) - 1, 1)]])
        assert np.allclose(x[d], want, atol=2e-3)
    rng = np.random.default_rng(5)
    net = quality.Network().fit(rng.normal(size=(200, 6)), np.arange(200) % 2)
    row = rng.normal(size=6)
    a, b, c, e = net.params
    scaled = [min(max((v - m) / s, -8), 8) for v, m, s in zip(row, net.mean, net.std)]
    hidden = [np.tanh(sum(scaled[i] * a[i, j] for i in range(6)) + b[j]) for j in range(net.hidden)]
    z = (sum(h * w for h, w in zip(hidden, c)) + e[0]) / net.temperature
    assert net.probability(row[None])[0] == pytest.approx(1 / (1 + np.exp(-z)))


def test_every_labelled_text_is_learnt_from_in_whole(spark, monkeypatch):
    """Long texts too, in several shards, whatever the partitions; every row
    counts for the thresholds."""
    monkeypatch.setattr(toxicity, "SHARD_BYTES", 300_000)
    monkeypatch.setattr(toxicity, "VISITS", 1600)
    rng = np.random.default_rng(8)
    docs = []
    for i in range(80):
        words = [f"w{k}" for k in rng.integers(0, 60, 3100)]
        if i % 2:
            words[2000:3000:100] = ["vile"] * 10
        docs.append((i, " ".join(words), "en" if i < 78 else "fr"))
    known = labels.known(spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id bigint, y int"), "y", 4, -2)
    assert known.count() == 80
    a, b = ({r["doc_id"]: r for r in toxicity.score(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(n), known).collect()}
        for rows, n in ((docs, 3), (docs[::-1], 7)))
    assert {k: r["threshold"] for k, r in a.items()} == {k: r["threshold"] for k, r in b.items()}
    assert {k: r["score"] for k, r in a.items()} == pytest.approx({k: r["score"] for k, r in b.items()}, rel=1e-3, abs=1e-7)
    assert min(a[i]["score"] for i in range(1, 80, 2)) > max(a[i]["score"] for i in range(0, 80, 2))


def test_temperature_and_thresholds_are_of_all_judged_rows(spark):
    rng = np.random.default_rng(6)
    y = (rng.random(3000) < 0.2).astype(int)
    z = rng.normal(y * 3 - 2, 1.5)
    langs = np.array(["en"] * 2500 + ["fr"] * 160 + ["de"] * 300 + ["none"] * 40)
    y[2660:2960] = 0  # no row of one class
    rows = spark.createDataFrame([(k if k != "none" else None, int(v), float(x)) for k, v, x in zip(langs, y, z)],
                                 "lang string, y int, logit double").repartition(5)
    t = toxicity.temperature_of(rows)
    assert t == pytest.approx(quality.temperature(z, y))
    own, common = toxicity.thresholds(rows, t)
    p = 1 / (1 + np.exp(-np.clip(z / t, -60, 60)))
    langs[langs == "none"] = ""
    want = toxicity.language_thresholds(p, y, langs)
    assert (y[2500:2660] == 1).sum() < 160 and {r["_lang"]: r["own"] for r in own.collect()} == want and "en" in want and "de" not in want
    assert common == toxicity.best_threshold(p, y)
