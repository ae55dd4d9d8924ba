"""Near-duplicates and substring dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cumulo.llm import common, icws, lattice, passages, suffixes
from cumulo.llm import components as joined
from cumulo.llm.components import components
from tests.llm.helpers import WORDS, awkward, frame, vocabulary


# --- components ----------------------------------------------------------------

def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (None, 3), (7, None), (201, 200), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- op8 -------------------------------------------------------------------------

def test_near_copies_group_and_others_do_not(spark):
    docs = frame(spark)
    rows = icws.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert {got[i]["component_id"] for i in (3, 5, 8)} == {3}
    assert got[3]["kept"] and not got[5]["kept"] and not got[8]["kept"]
    assert got[3]["n_members"] == 4  # with the row of a null id
    for i in (1, 2, 9, 10, 11, 12, 13, 15, 16, 17, 100, 129):
        assert got[i]["component_id"] == i and got[i]["kept"]
    none = [r for r in rows if r["doc_id"] is None]
    assert sorted(r["kept"] for r in none) == [False, True]  # a copy, and a text of no words
    out = icws.deduplicated(docs)
    assert out.columns == docs.columns
    ids = Counter(r["doc_id"] for r in out.collect())
    assert ids[14] == 1 and ids[5] == 0 and ids[3] == 1 and ids[None] == 1
    assert icws.near_duplicates(frame(spark, [])).count() == 0 and icws.deduplicated(frame(spark, [])).count() == 0


def test_samples_agree_as_often_as_the_similarity(spark):
    import pyarrow as pa
    rng, vocab = random.Random(5), vocabulary(3000)
    left = [rng.choice(vocab) for _ in range(400)]
    right = list(left)
    for i in rng.sample(range(400), 12):
        right[i] = rng.choice(vocab)
    texts = pa.array([" ".join(left), " ".join(right)])
    idf = np.full(icws.DF_BUCKETS, 1.5, np.float32)
    similarity = icws.weighted_jaccard(texts[:1], texts[1:], idf)[0]
    a, b = ({tuple(w[i:i + 5]) for i in range(396)} for w in (left, right))
    assert similarity == pytest.approx(len(a & b) / len(a | b), abs=1e-6)
    agree = []
    for seed in range(30):
        sampler = icws.Sampler()
        sampler.odd = np.random.default_rng(seed).integers(2**40, 2**62, sampler.odd.shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        doc, key, tf = icws.shingles(texts)
        _, bands = sampler.sample(doc, key, tf * 1.5)
        agree += (bands[0] == bands[1]).tolist()
    assert np.mean(agree) == pytest.approx(similarity ** icws.ROWS, abs=0.1)


def test_large_groups_of_near_copies(spark):
    """More members than a bucket compares to the end; every copy is found."""
    rng, vocab = random.Random(6), vocabulary(2000)
    base = [rng.choice(vocab) for _ in range(200)]
    rows = []
    for i in range(120):
        w = list(base)
        w[rng.randrange(200)] = f"edit{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(rng.choice(vocab) for _ in range(100))) for i in range(30)]
    got = icws.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sum(r["kept"] for r in got) == 31
    assert {r["component_id"] for r in got if r["doc_id"] < 120} == {0}


def brute_groups(rows, threshold=0.8):
    """Least id of each id's group by the weighted Jaccard of all pairs, and
    the similarities over half of it."""
    rows = sorted(rows)
    sets = [Counter(zip(*[WORDS(t)[k:] for k in range(5)])) for _, t in rows]
    column = {s: k for k, s in enumerate({s for c in sets for s in c})}
    tf = np.zeros((len(rows), len(column)))
    for k, c in enumerate(sets):
        tf[k, [column[s] for s in c]] = list(c.values())
    weight = tf * (1 + np.log(len(rows) / (tf > 0).sum(0)) / np.log(len(rows)))
    total, root, near = weight.sum(1), np.arange(len(rows)), {}
    for a in range(1, len(rows)):
        has = weight[a] > 0
        shared = np.minimum(weight[a, has], weight[:a][:, has]).sum(1)
        for b, similarity in enumerate(shared / (total[a] + total[:a] - shared)):
            if similarity > threshold / 2:
                near[rows[b][0], rows[a][0]] = similarity
            if similarity >= threshold:
                root[root == max(root[a], root[b])] = min(root[a], root[b])
    return {i: rows[r][0] for (i, _), r in zip(rows, root)}, near


def template_family(members=300, pairs=40):
    """Texts that share 272 words and end in 20 to 30 of their own, and
    pairs that share part of the end too."""
    rng, vocab = random.Random(17), vocabulary(3000)
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    template = words(272)
    rows = [(i, " ".join(template + words(rng.randrange(20, 31)))) for i in range(members)]
    for i in range(pairs):
        end, cut = words(22), 12 - i % 5
        rows += [(1000 + 2 * i + j, " ".join(template + end[:cut] + words(22 - cut))) for j in range(2)]
    return rows + [(2000 + i, " ".join(words(100))) for i in range(20)]


def test_pairs_in_a_family_with_a_template(spark):
    """Buckets of hundreds of texts just under the threshold; planted pairs over it."""
    rows = template_family()
    want, near = brute_groups(rows)
    family = [v for (a, b), v in near.items() if b < 1000]
    planted = [near[1000 + 2 * i, 1001 + 2 * i] for i in range(40)]
    assert 0.65 < min(family) and max(family) < 0.795 and 0.805 < min(planted) and max(planted) < 0.9
    got = icws.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_groups_that_straddle_the_threshold(spark):
    """Copies with edits whose mutual similarity is on both sides of it."""
    rng, vocab = random.Random(18), vocabulary(3000)
    rows = []
    for _ in range(3):
        base = [rng.choice(vocab) for _ in range(200)]
        for _ in range(70):
            w = list(base)
            for at in rng.sample(range(200), rng.randrange(1, 5)):
                w[at] = rng.choice(vocab)
            rows.append((len(rows), " ".join(w)))
    want, near = brute_groups(rows)
    assert min(near.values()) < 0.7 and max(near.values()) > 0.9
    got = icws.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_links_are_joined_in_few_written_tables(spark, monkeypatch):
    """A written table costs a file of every shuffle partition, however small it is."""
    written = []
    for module in (icws, joined):
        monkeypatch.setattr(module, "stage", lambda df, name: written.append(name) or common.stage(df, name))
    rows = template_family(80, 20)
    got = icws.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_groups(rows)[0]
    assert "rare-texts" in written  # a bucket went all the way
    assert len(written) <= 30, written


# --- op9 -------------------------------------------------------------------------

def test_lattice_points_are_nearest():
    rng = np.random.default_rng(0)
    y = rng.normal(0, 1.5, (300, 8))
    point = lattice.nearest_e8(y)
    doubled = 2 * point
    assert np.array_equal(doubled, np.rint(doubled)) and (point.sum(1) % 2 == 0).all()
    assert ((doubled % 2 == 0).all(1) | (doubled % 2 == 1).all(1)).all()
    near = point[:, None, :] + lattice.shortest_vectors()[None]
    assert (((y - point) ** 2).sum(1) <= ((y[:, None, :] - near) ** 2).sum(2).min(1) + 1e-9).all()
    assert lattice.shortest_vectors().shape == (240, 8)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    for cosine, least in ((0.93, 0.9), (0.96, 0.97)):
        b = cosine * a + np.sqrt(1 - cosine ** 2) * side
        label = np.zeros(len(a), np.int64)
        shape = (len(a), lattice.TABLES, -1)
        met = (lattice.cells(a, label, True).reshape(shape) == lattice.cells(b, label, False)[:, :, None])
        back = (lattice.cells(b, label, True).reshape(shape) == lattice.cells(a, label, False)[:, :, None])
        assert (met | back).any(axis=(1, 2)).mean() >= least


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        for _ in range(rng.integers(1, 8)):
            rows.append((len(rows), (centre + rng.normal(0, 0.05, 16)).tolist(), int(c % 3)))
    rows += [(100, rows[0][1], rows[0][2]), (101, rows[0][1], 99), (101, rows[0][1], 99), (102, None, 1), (103, [0.0] * 16, 1),
             (104, [None] + [1.0] * 15, 1), (105, [float("nan")] + [1.0] * 15, 1), (106, [float("inf")] + [1.0] * 15, 1),
             (107, rows[0][1], None), (None, rows[0][1], 0), (108, [], 1), (109, [1.0, 2.0], 1), (110, [2.0, 4.0], 1),
             (111, (np.array(rows[1][1]) * 1e-30).tolist(), rows[1][2])]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, n_links int, cell string")
    got = lattice.near_duplicates(df).collect()
    assert len(got) == len(rows)
    ok = [i for i, (v, e, la) in enumerate(rows) if v is not None and la is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    link = {i: set() for i in range(len(rows))}
    for x in ok:
        for y in ok:
            if x != y and rows[x][2] == rows[y][2] and len(rows[x][1]) == len(rows[y][1]):
                p, q = np.array(rows[x][1]), np.array(rows[y][1])
                if p @ q / (np.linalg.norm(p) * np.linalg.norm(q)) >= 0.93:
                    link[x].add(y)
    root = list(range(len(rows)))
    for _ in range(len(rows)):
        for x in ok:
            root[x] = min([root[x], *(root[y] for y in link[x])], key=lambda i: (rows[i][0], i))
    want = Counter((rows[i][0], len(link[i]), rows[root[i]][0], rows[i][0] is not None and rows[i][0] == rows[root[i]][0]) for i in range(len(rows)))
    assert Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == want
    assert lattice.near_duplicates(df.limit(0)).count() == 0


# --- op4 -------------------------------------------------------------------------

def brute_passages(rows):
    first = {}
    rank = lambda i: 2**63 - 1 if i is None else i
    for i, t in rows:
        w = WORDS(t or "")
        for k in range(len(w) - 12):
            g = tuple(w[k:k + 13])
            first[g] = min(first.get(g, 2**63), rank(i))
    out = Counter()
    for i, t in rows:
        w = WORDS(t or "")
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < rank(i):
                gone |= set(range(k, k + 13))
        out[i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)] += 1
    return out


@pytest.mark.parametrize("block_words", [300_000, 40])
def test_passages_against_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(passages, "BLOCK_WORDS", block_words)
    rng, vocab = random.Random(9), vocabulary(12)  # few words: much repeats by chance
    more = [(500 + i, " ".join(rng.choice(vocab[:2]) for _ in range(rng.randrange(10, 60)))) for i in range(40)]
    rows = [(r[0], r[1]) for r in awkward()] + more
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id bigint, text string, n_words int, run string")
    got = passages.remove_repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == brute_passages(rows)


def test_text_that_repeats_itself_is_located_in_linear_time():
    import time
    import pyarrow as pa
    table = lambda **c: pa.table(c)
    took = []
    for n in (20_000, 100_000):
        for unit in ("w", "a b c", "a b c d e f g h"):
            one = " ".join([unit] * (n // len(unit.split(" "))))
            other = " ".join(one.split(" ")[:-5] + ["x"] + one.split(" ")[:n // 2])
            began = time.time()
            got = passages.locate(table(number=[1, 2], rank=[5, 6], run=[other, "y " + one]), table(block=[0], first_rank=[3], passage=[one]))
            took.append(time.time() - began)
            for which, text in ((1, other), (2, "y " + one)):
                words, gone = text.split(" "), set()
                for b, e in zip(*(got.filter(pa.compute.equal(got["number"], which))[c].to_pylist() for c in ("begin", "end"))):
                    gone |= set(range(b, e))
                assert gone == {i for i, w in enumerate(words) if w not in "xy"}
    assert max(took) < 20, took


def test_passages_of_repeating_documents(spark):
    rows = [(1, "w " * 900), (2, "w " * 1100 + "z"), (3, "a b " * 400 + "c " * 13), (4, "b a " * 300), (5, "x " + "c " * 12)]
    got = passages.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == brute_passages(rows)


def test_passages_keep_columns_and_empty_tables(spark):
    docs = frame(spark)
    out = passages.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    whole = {r[0]: r[1] for r in awkward()}
    assert kept[1] == whole[1] and kept[2] == "" and kept[9] != whole[9] and kept[10] is None
    assert passages.without_repeats(frame(spark, [])).count() == 0


# --- op10 ------------------------------------------------------------------------

@pytest.mark.parametrize("length", [1, 3, 8])
def test_interval_expansion_against_brute_force(length):
    rng = random.Random(length)
    for _ in range(60):
        contents = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 40))) for _ in range(rng.randrange(1, 6))]
        count = Counter(c[i:i + length] for c in contents for i in range(len(c) - length + 1))
        want = [[count[c[i:i + length]] > 1 for i in range(len(c) - length + 1)] for c in contents]
        assert [m.tolist() for m in suffixes.repeated_starts(contents, length)] == want


def brute_bytes(rows, length=400):
    raw = [(t or "").encode() for _, t in rows]
    count = Counter(b[k:k + length] for b in raw for k in range(len(b) - length + 1))
    out = Counter()
    for (i, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans = bytes(gone).split(b"\0")
        out[i, len(b), sum(gone), sum(1 for s in spans if s), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()] += 1
    return out


@pytest.mark.parametrize("many", [1500, 1])
def test_byte_strings_against_brute_force(spark, monkeypatch, many):
    monkeypatch.setattr(suffixes, "MANY", many)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 5000)
    rng, vocab = random.Random(11), vocabulary(500)
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    part = text(100)
    rows = [(r[0], r[1]) for r in awkward() if r[0] != 16]
    rows += [(300 + i, text(20) + part[i:500 + 3 * i] + text(20)) for i in range(25)]  # overlapping cuts of one passage
    rows += [(400, "ab" * 700), (401, text(10) + "ab" * 300), (402, "é" * 450 + "x"), (403, part[:399]), (404, part[1:400])]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id bigint, text string, n_bytes int, key string")
    got = suffixes.remove_repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
                   for r in got) == brute_bytes(rows)
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0
