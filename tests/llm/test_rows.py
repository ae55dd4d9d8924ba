"""URL filter, mixing, BPE and host rules on awkward rows."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cumulo.llm import bpe, hostrules, mixing, urlfilter
from cumulo.llm.queries import RULES
from tests.llm.helpers import SCHEMA, WORDS, awkward, frame


# --- op1 ---------------------------------------------------------------------

def page(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, verdict string")


def verdicts(df):
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in df.collect()}


def test_rules_and_longest_match(spark):
    got = verdicts(urlfilter.judge(page(spark, [(i, u, None, "x", "y") for i, u in enumerate([
        "http://WWW.Example.com/en/1?q=/es/", "https://m.example.com/en/", "https://example.com/de", "http://a.net/es/1#x",
        "http://anet/es/", "http://x.net", None, "no scheme", "http://y.com?x=1"])]), RULES))
    assert got == {0: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
                   1: ("m.example.com", "/en/", "example.com/en/", "block"), 2: ("example.com", "/de", "com/", "allow"),
                   3: ("a.net", "/es/1", "net/es/", "block"), 4: ("anet", "/es/", None, "allow"),
                   5: ("x.net", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"),
                   8: ("y.com", "", None, "allow")}


def test_blocks_reach_aliases_and_allow_wins(spark):
    canon = '<link rel="canonical" href="{}">'.format
    moved = "<META http-equiv=refresh content='0; url={}'>".format
    got = verdicts(urlfilter.judge(page(spark, [
        (1, "http://a.org/1", canon("http://b.org/2"), "", ""), (2, "http://b.org/2", moved("http://c.net/es/9"), "", ""),
        (3, "http://c.net/es", None, "", ""),      # closing slash: an alias of ...
        (4, "http://c.net/es/?utm_source=x", None, "", ""),
        (5, "http://d.org/5", canon("http://e.net/fr/1") + canon("http://www.example.com/en/1"), "", ""),  # allow precedence
        (6, "http://f.org/6", canon("/7"), "", ""), (7, "http://f.org/7", None, "", "")]), RULES))
    assert [got[i][3] for i in (1, 2, 3, 4, 5, 6, 7)] == ["block", "block", "block", "block", "allow", "allow", "allow"]


def test_relative_links_and_entities(spark):
    canon = '<link rel="canonical" href="{}">'.format
    moved = "<META http-equiv=refresh content='0; url={}'>".format
    links = {1: ("http://c.net/es/a", ""), 2: ("http://b.org/x/2", canon("f.html")), 3: ("http://b.org/x/f.html", moved("//c.net/es/a")),
             4: ("http://d.org/q", canon("?a=1&amp;b=2")), 5: ("http://d.org/q?a=1&b=2", canon("http://c.net/es/a")),
             6: ("http://e.org", canon("./x/../../y/")), 7: ("http://e.org/y", canon("http://c.net/es/a#z")),
             8: ("http://f.org/8", canon("#top") + canon("mailto:x@c.net/es/") + canon("javascript://c.net/es/a")[:0]),
             9: ("http://g.org/a/b/c?q=/x/", moved("../../z?u=1&amp;v=2#s")), 10: ("http://g.org/z?u=1&v=2", canon("http://c.net/es/a")),
             11: ("http://h.org/a/", canon("..")), 12: ("http://h.org/", canon("http://c.net/es/a")), 13: ("http://i.org/1", canon(""))}
    got = verdicts(urlfilter.judge(page(spark, [(i, u, h, "", "") for i, (u, h) in links.items()]), RULES))
    assert {i: v[3] for i, v in got.items()} == {i: "allow" if i in (8, 13) else "block" for i in links}


def test_link_oracle_sees_relative_links(spark, tmp_path):
    import duckdb
    from cumulo.llm.queries import OP1_SQL, op1_urls
    rng = __import__("random").Random(8)
    paths = ["", "/", "/es/", "/es/x", "/fr/1", "/en/1", "/a/b/c", "/a/b/"]
    made = ["x", "../x", "./", "?q=1", "?q=1&amp;r=2", "#s", "/es/x", "//n{}.net/es/", "../../fr/1?z#y", "mailto:a@b", "http://n{}.net/es/x", "", "a/./b/../c",
            "HTTPS://O{}.org/a"]
    rows = []
    for i in range(400):
        tag = rng.choice(['<link rel="canonical" href="{}">', "<link href='{}' rel=canonical>", "<META http-equiv='refresh' content='0; URL={}'>", "{}"])
        host = rng.choice(["n{}.net", "o{}.org", "O{}.org", "www.example.com", "example.com"]).format(i // 4)
        link = tag.format(rng.choice(made).format(i // 4))
        rows.append((i, f"http://{host}{rng.choice(paths)}{rng.choice(['', '?q=1', '?utm_a=1', '#f'])}", f"<p>{link}</p>"))
    spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = db.execute(OP1_SQL).fetchall()
    got = op1_urls(spark, str(tmp_path))
    names = [d[0] for d in db.description]
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(repr, want))
    assert sum(r["alias_of_block"] for r in got.collect()) > 20


def test_empty_pages(spark):
    assert urlfilter.judge(page(spark, []), RULES).count() == 0


# --- op2 ---------------------------------------------------------------------

def test_mix_takes_each_budget_exactly(spark):
    rows = awkward()
    got = mixing.mix(frame(spark).drop("mix_size")).collect()
    assert len(got) == len(rows)
    size, target, taken = defaultdict(int), {}, defaultdict(int)
    for r in got:
        assert r["mix_size"] == len(WORDS(r["text"] or ""))
        assert 0 <= r["mix_taken"] <= 2 * r["mix_size"]
        size[r["source"]] += r["mix_size"]
        target[r["source"]] = r["mix_target"]
        taken[r["source"]] += r["mix_taken"]
    for s in size:
        assert taken[s] == int(target[s]) and target[s] <= 2 * size[s]
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    again = mixing.mix(frame(spark).drop("mix_size").repartition(7)).collect()
    key = lambda rs: sorted((repr(r["doc_id"]), r["mix_taken"], r["mix_size"]) for r in rs)
    assert key(again) == key(got)


def test_targets_reach_the_water_level(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), (None, 50), ("d", 0)], "_src string, _src_size bigint")
    got = {r["_src"]: r["_target"] for r in mixing.source_targets(sizes).collect()}
    names, size = ["a", "b", "c", "d", None], {"a": 10, "b": 1000, "c": 100, "d": 0, None: 50}
    weight = dict(zip(names, [3, 1, 2, 3, 1]))
    want, rest, open_ = {}, 1.5 * 1160, set(names)
    while open_:  # reshare until no target is above its cap
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 2 * size[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 2.0 * size[s]
            rest -= want[s]
        open_ -= over
    assert got == pytest.approx(want)


def test_mixed_rows_keep_columns_and_clashing_names(spark):
    docs = frame(spark)
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    want = {r["doc_id"]: r["mix_taken"] for r in mixing.mix(docs.drop("mix_size")).filter("doc_id is not null").collect()}
    got = Counter()
    for r in out.filter("doc_id is not null").collect():
        got[r["doc_id"]] += len(WORDS(r["text"]))
    unique = {d for d in want if d != 14}
    assert {d: got[d] for d in unique} == {d: want[d] for d in unique}
    assert mixing.mixed_rows(frame(spark, [])).count() == 0 and mixing.mix(frame(spark, []).drop("mix_size")).count() == 0


CLASHING = ("_key", "_range", "_src", "_rng", "_offset", "_target", "_own", "_own_key", "_before", "mix_size", "MIX_taken", "_h", "_host",
            "_counts", "_text", "ids")


def clashing(spark):
    docs = frame(spark)
    docs = docs.select("doc_id", "text", "lang", "source")
    for i, c in enumerate(CLASHING):
        docs = docs.withColumn(c, docs["doc_id"] * 100 + i)
    return docs


def test_mix_with_clashing_names(spark):
    docs = clashing(spark)
    got, plain = mixing.mix(docs), mixing.mix(frame(spark).select("doc_id", "text", "lang", "source"))
    kept = [c for c in docs.columns if c.lower() not in ("mix_size", "mix_taken")]
    new = ["mix_size", "mix_source_size", "mix_target", "mix_epochs", "mix_taken"]
    assert got.columns == kept + new
    key = lambda df: sorted(repr((r["doc_id"], *(r[c] for c in new))) for r in df.collect())
    assert key(got) == key(plain)
    assert all(r[c] == (None if r["doc_id"] is None else r["doc_id"] * 100 + CLASHING.index(c)) for r in got.collect() for c in kept if c.startswith("_"))
    assert mixing.mixed_rows(docs).columns == docs.columns


@pytest.mark.parametrize("count_once", [True, False])
def test_host_rules_with_clashing_names(spark, count_once):
    docs, keep = clashing(spark), ["doc_id", "_h", "_host", "_counts", "_own", "_text"]
    got = hostrules.judge(docs, keep, count_once=count_once).collect()
    plain = hostrules.judge(frame(spark), ["doc_id"]).collect()
    new = [*hostrules.COUNTS, "base_failed", "host_docs", "host_failures", "host_rate", "kept"]
    assert sorted(repr((r["doc_id"], *(r[c] for c in new))) for r in got) == sorted(repr((r["doc_id"], *(r[c] for c in new))) for r in plain)
    assert all(r[c] == (None if r["doc_id"] is None else r["doc_id"] * 100 + CLASHING.index(c)) for r in got for c in keep[1:])
    assert hostrules.passing(docs).columns == docs.columns


# --- op6 ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return path, tok


def test_bpe_equals_the_library(spark, library):
    path, tok = library
    docs = frame(spark)
    got = bpe.encode(docs, path, ["doc_id", "text", "n_words"]).collect()
    assert len(got) == docs.count()
    for r in got:
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == tok.decode(ids, skip_special_tokens=False)
    assert bpe.encode(frame(spark, []), path, ["doc_id"]).count() == 0


def test_bpe_with_clashing_names(spark, library):
    path, _ = library
    got = bpe.encode(clashing(spark), path, ["doc_id", "_text", "ids", "_key"])
    assert got.columns == ["doc_id", "_text", "_key", "n_tokens", "ids", "decoded"]
    plain = bpe.encode(frame(spark), path, ["doc_id"]).collect()
    rows = got.collect()
    assert sorted(repr((r["doc_id"], bytes(r["ids"]))) for r in rows) == sorted(repr((r["doc_id"], bytes(r["ids"]))) for r in plain)
    assert all(r["_text"] == (None if r["doc_id"] is None else r["doc_id"] * 100 + CLASHING.index("_text")) for r in rows)


def test_bpe_on_random_code_points(library):
    import random
    path, tok = library
    rng = random.Random(3)
    texts = ["".join(chr(rng.choice([rng.randrange(9, 127), rng.randrange(160, 0x600), rng.randrange(0x1E00, 0xD7FF),
                                     rng.randrange(0x10000, 0x1FB00)])) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["ΟΔΟΣ ΣΑΣ İ ẞ", "it's we'LL 'd", "aaaaaaaaaaaaaaaaaaaaaaa" * 40, "<|startoftext|><|endoftext|", "\x1c\x85 x"]
    coder = bpe.Bpe(path)
    for t, (ids, decoded), e in zip(texts, coder.encode(texts), tok.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == e.ids, t
        assert decoded == tok.decode(e.ids, skip_special_tokens=False)


# --- op7 ---------------------------------------------------------------------

def brute_counts(text):
    text = text or ""
    w = WORDS(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORDS(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_counts_and_verdicts(spark):
    docs = frame(spark).drop("n_words", "kept")
    got = hostrules.judge(docs, ["doc_id", "text", "source"]).collect()
    assert len(got) == docs.count()
    for r in got:
        n, chars, symbols, dup, repeat = brute_counts(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert r["kept"] == (not r["base_failed"] and r["host_rate"] <= 0.5)
    with pytest.raises(ValueError, match="clash"):
        hostrules.judge(frame(spark), ["doc_id", "kept"])


def test_a_bad_host_takes_its_documents_along_and_few_failures_shrink(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "short"
    rows = [(i, good if i % 50 else bad, "en", "fine", 0) for i in range(200)]
    rows += [(1000 + i, bad if i % 20 else good, "en", "junk", 0) for i in range(100)]
    rows += [(2000, bad, "en", "new", 0), (2001, good, "en", "new", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r["doc_id"]: r for r in hostrules.judge(docs, ["doc_id", "source"]).collect()}
    assert not any(r["kept"] for r in got.values() if r["source"] == "junk")
    assert got[1]["kept"] and got[2001]["kept"]
    assert 0.04 < got[2001]["host_rate"] < 0.5  # one of two, shrunk towards the corpus
    assert {c: t for c, t in hostrules.passing(docs).dtypes} == dict(docs.dtypes)


def test_passing_keeps_columns(spark):
    docs = frame(spark)
    out = hostrules.passing(docs)
    assert out.columns == docs.columns and 0 < out.count() < docs.count()
    assert hostrules.passing(frame(spark, [])).count() == 0


def test_digest_of_packed_ids(spark, library):
    from pyspark.sql import functions as F
    path, tok = library
    docs = spark.createDataFrame([(1, "hello world")], "doc_id bigint, text string")
    r = bpe.encode(docs, path, ["doc_id"]).select(F.sha2("ids", 256).alias("h")).collect()[0]["h"]
    ids = tok.encode("hello world", add_special_tokens=False).ids
    assert r == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_schema_has_the_clashes():
    assert "mix_size" in SCHEMA and "_text" in SCHEMA
