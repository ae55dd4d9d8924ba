"""Phrase mining against counting every sequence."""

import re
from collections import Counter

import pytest

from cumulo.llm import phrases
from tests.llm.helpers import SCHEMA, awkward, frame

CUT = re.compile("[.,;:!?\n-\r]")
UPPER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(rows, least, top):
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in CUT.split((text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    count[lang, tuple(words[i:i + k])] += 1
    cand = {p: n for p, n in count.items() if n >= least and len(p[1]) > 1}
    inside = set()
    for (lang, w), n in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if 100 * n >= 100 * cand[lang, w[i:i + k]]:
                    inside.add((lang, w[i:i + k]))
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) in inside:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = count[lang, w[:k]], count[lang, w[k:]]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, total[lang], -s)
                  for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def found(docs, least, top):
    cols = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in cols) for r in phrases.collocations(docs, least, top).collect())


@pytest.mark.parametrize("least,top", [(2, 2000), (3, 7), (40, 50)])
def test_awkward_rows(spark, least, top):
    rows = awkward()
    rows += [(500 + i, "New York, new york City! of the; of\tthe\vof the\x0cend Of THE end", lang, "a", 1, 7, False, "r", "t", 3, 4, 1, 2, 0)
             for i, lang in enumerate(["en", None, "und", "fr", "é"] * 9)]
    want = brute([(r[2], r[1]) for r in rows], least, top)
    assert want and found(frame(spark, rows), least, top) == want


def test_spills_bursts_and_steps_change_nothing(spark, monkeypatch):
    rows = awkward()
    for name, value in (("BURST", 3), ("MOST_ENTRIES", 50), ("MOST_WORDS", 40), ("STEP", 64)):
        monkeypatch.setattr(phrases, name, value)
    docs = frame(spark, rows).coalesce(2).select("lang", "text")
    batches = [b for b in docs.toArrow().select(["lang", "text"]).to_batches()]
    entries = lambda run: {(run.column(1)[0].as_py(), p): n for p, n in zip(run.column(2)[0].as_py(), run.column(3)[0].as_py())}
    counter = phrases._Counter()  # the same steps in this process, where the bounds hold
    seen = Counter()
    spilled = 0
    for lang, texts in (x for b in batches for x in phrases._parts(b.set_column(0, "lang", phrases.pc.fill_null(b.column(0), "und")))):
        words, _, piece = phrases._words(texts)
        if not len(words):
            continue
        coded = words.dictionary_encode()
        word, vocab = coded.indices.to_numpy().astype("int64"), coded.dictionary.to_pylist()
        good = {2: phrases.np.ones(len(word), bool), 3: phrases.np.ones(len(word), bool)}
        for lo in range(0, len(word), 64):
            hi = lo + 64 + phrases.LONGEST - 1
            counter.count(lang, vocab, word[lo:hi], {k: g[lo:hi] for k, g in good.items()}, piece[lo:hi], (2, 3, 4, 5))
            runs = list(counter.spill(counter.full(), 3)) if counter.full() or counter.trie.entries > 50 else []
            spilled += len(runs)
            for run in runs:
                assert run.column(2)[0].as_py() == sorted(run.column(2)[0].as_py())
                seen.update(entries(run))
    for run in counter.spill(True, 3):
        seen.update(entries(run))
    every = Counter()
    for r in rows:
        for p in CUT.split((r[1] or "").translate(UPPER)):
            words = re.findall("[^ \t]+", p)
            for k in range(2, 6):
                for i in range(len(words) - k + 1):
                    every[r[2] or "und", " ".join(words[i:i + k])] += 1
    assert spilled > 10 and seen == every


def test_empty_and_null(spark):
    assert found(frame(spark, []), 1, 10) == []
    rows = [(1, t, None, None, 0, 0, None, None, None, 0, 0, 0, 0, 0) for t in (None, "", " \t\n", "...", "one")]
    assert found(spark.createDataFrame(rows, SCHEMA), 1, 10) == []


def test_scores_beyond_64_bits(spark):
    row = spark.sql("select (1000 * cast(a as decimal(16,0)) * cast(t as decimal(16,0))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0))) s "
                    "from values (9000000000001L, 9900000000007L, 9100000000003L, 9000000000001L) v(a, t, l, r)").first()
    assert row["s"] == 1000 * 9000000000001 * 9900000000007 // (9100000000003 * 9000000000001)
