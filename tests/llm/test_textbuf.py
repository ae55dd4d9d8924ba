"""Words, tokens and fingerprints against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cumulo.llm import textbuf as tb
from tests.llm.helpers import WORDS

texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1c漢#1A", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_equal_the_pattern(rows):
    data, offs = tb.buffer(pa.array(rows, pa.string()))
    s, e, doc = tb.words(data, offs)
    got = [[] for _ in rows]
    for a, b, d in zip(s, e, doc):
        got[d].append(bytes(data[a:b]).decode())
    assert got == [WORDS(t or "") for t in rows]


@settings(max_examples=40, deadline=None)
@given(texts)
def test_fingerprints_follow_content(rows):
    data, offs = tb.buffer(pa.array(rows, pa.string()))
    s, e, _ = tb.words(data, offs)
    seen = {}
    for key, a, b in zip(tb.Rolling(data).of(s, e), s, e):
        assert seen.setdefault(int(key), bytes(data[a:b])) == bytes(data[a:b])
    assert len(seen) == len({bytes(data[a:b]) for a, b in zip(s, e)})


def test_tokens_are_cut_at_classes():
    data, offs = tb.buffer(pa.array(["Then** ABC!! a1é", None, "|x"]))
    s, e, doc = tb.tokens(data, offs)
    assert [bytes(data[a:b]).decode() for a, b in zip(s, e)] == ["Then", "**", "ABC", "!!", "a", "1", "é", "|", "x"]
    assert doc.tolist() == [0] * 7 + [2] * 2


def test_run_minima_and_slices():
    v = np.random.default_rng(0).integers(0, 2**63, 500, dtype=np.uint64) % np.uint64(7) << np.uint64(40)
    for width in (1, 4, 13, 499, 500, 501):
        got = tb.run_minima(v, width)
        want = [i + int(np.argmin(v[i:i + width])) for i in range(len(v) - width + 1)]  # leftmost on ties
        assert got.tolist() == want
    batch = pa.RecordBatch.from_arrays([pa.array(["aaaa", "b", "", None, "c" * 50])], names=["t"])
    parts = list(tb.slices(batch, 0, 6))
    assert sum(p.num_rows for p in parts) == 5 and all(p.num_rows for p in parts)
    assert re.sub("", "", "".join(t or "" for p in parts for t in p.column(0).to_pylist())) == "aaaab" + "c" * 50
