"""Tokenizer alignment against whole texts encoded one by one."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cumulo.llm import alignment
from cumulo.llm.bpe import _byte_chars
from tests.llm.helpers import awkward, frame

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def brute(texts):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    back = {c: i for i, c in enumerate(_byte_chars())}

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    docs, count = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        raw_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes_b(i) for i in ids_b]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            docs.append(([], [], [], set()))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]), np.cumsum([len(x) for x in raw_b])
        links, i, j = [], 0, 0
        while i < len(ids_a) and j < len(ids_b):
            links.append((ids_a[i], ids_b[j]))
            x, y = ends_a[i], ends_b[j]
            i, j = i + (x <= y), j + (y <= x)
        both = set(ends_a) & set(ends_b)
        groups, ga, gb = [], [], []
        ia, ib = 0, 0
        for end in sorted(both):
            ga, gb = [], []
            while ia < len(ids_a) and ends_a[ia] <= end:
                ga.append(str(ids_a[ia]))
                ia += 1
            while ib < len(ids_b) and ends_b[ib] <= end:
                gb.append(str(ids_b[ib]))
                ib += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        docs.append((ids_a, ids_b, groups, links))
        count.update(set(links))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return sorted(((len(x), len(y), len(g), len(li), sum(count[p] == most[p[0]] for p in li), sum(count[p] for p in li), ";".join(g))
                   for x, y, g, li in docs), key=repr)


def found(docs):
    return sorted((tuple(r[c] for c in COLS) for r in alignment.align(docs, A, B, ["doc_id"]).collect()), key=repr)


STRANGE = ["a  b", " a", "a ", "  ", " ", "\n", "a\n b", "a \nb", "a▁b", "<s> </s><|endoftext|> <unk>", "it's we'll 12 345", "x\x00y",
           "tab\t x\ty", "nb  sp 　 wide", "  line  ", "\x1c \x85 x", "é é ﬁ ①", "😀 👩‍👩‍👧 日本 語", "a" * 3000,
           "word " * 2000, "  ᠎ x", "I don 't ' t", "a - b -- c . . .", "xylophonezebra quixotically a▁b",
           "only▁here"]


def test_awkward_rows(spark):
    rows = awkward()
    rows += [(700 + i, t, "en", "a", 1, 7, False, "r", "t", 3, 4, 1, 2, 0) for i, t in enumerate(STRANGE + STRANGE[:3])]
    assert found(frame(spark, rows)) == brute([r[1] for r in rows])


def test_random_strings():
    import random

    rng = random.Random(5)
    signs = [" ", " ", " ", "a", "the", "'s", "\n", "\t", "1", "é", "▁", "日", " ", ".", "!", "Ab", " ", "😀"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    got, aligner = [], alignment.load(A, B)
    for t in texts:
        al = aligner.align(alignment._segments(t))
        got.append(";".join(al.texts()) if al.good.all() else "")
    data, offs = alignment.tb.buffer(alignment.pa.array([" " + t for t in texts]))
    starts = alignment._segment_starts(data, offs)
    cut = [data[a:b].tobytes().decode()[1:] for a, b in zip(starts, [*starts[1:], len(data)])]
    assert cut == [s for t in texts for s in alignment._segments(t)]
    assert sorted(got) == sorted(x[-1] for x in brute(texts))


def test_several_passes_flushes_and_tree_steps(spark, monkeypatch):
    rows = awkward()
    want = brute([r[1] for r in rows])
    for name, value in (("PASS_PAIRS", 400), ("FAN", 2)):
        monkeypatch.setattr(alignment, name, value)
    assert found(frame(spark, rows).repartition(5)) == want


def test_empty(spark):
    assert found(frame(spark, [])) == []


def test_kept_columns_may_have_any_name(spark):
    docs = frame(spark).selectExpr("doc_id as groups", "text as n_a", "text", "doc_id as _text", "lang as _n_best")
    got = alignment.align(docs.select("groups", "_text", F_n_a := "n_a", "_n_best", "text"), A, B, ["_text", "_n_best"])
    assert got.count() == len(awkward()) and got.columns[:2] == ["_text", "_n_best"] and F_n_a not in got.columns[:2]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**47, n))
    made = alignment.PerfectHash.unpack(*alignment.PerfectHash.build(keys).pack())
    assert sorted(made.slots(keys).tolist()) == list(range(len(keys)))
    other = np.setdiff1d(np.random.default_rng(n + 1).integers(0, 2**47, 1000), keys)
    assert (made.slots(other) < max(len(keys), 1)).all()
