"""The pipeline, stage by stage against the operators' brute-force versions."""

from collections import Counter

import corpus_pipeline as P
from tests.conftest import SF_SMALL
from tests.llm.helpers import WORDS, frame
from tests.llm.test_dedup import brute_passages
from tests.llm.test_rows import brute_counts


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    rows = docs.collect()
    for name, step in P.STAGES:
        out = step(spark, docs, SF_SMALL)
        got = out.collect()
        if name == "quality rules":
            want = [r for r in rows if (c := brute_counts(r["text"]))[0] >= 50 and 100 * c[4] <= 50 * c[0]]
            assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in want)
        elif name == "near-dedup":
            assert {r["doc_id"] for r in got} <= {r["doc_id"] for r in rows}
            shingles = {r["doc_id"]: frozenset(zip(*[WORDS(r["text"])[i:] for i in range(5)])) for r in rows}
            left = [r["doc_id"] for r in got]
            for i, a in enumerate(left):  # none left of clear near copies; who went had one with a smaller id
                for b in left[:i]:
                    assert len(shingles[a] & shingles[b]) < 0.9 * len(shingles[a] | shingles[b])
            for r in rows:
                if r["doc_id"] not in set(left):
                    a = shingles[r["doc_id"]]
                    assert any(len(a & s) > 0.6 * len(a | s) for d, s in shingles.items() if d != r["doc_id"])
        elif name == "passage dedup":
            want = brute_passages([(r["doc_id"], r["text"]) for r in rows])
            assert Counter((r["doc_id"], tuple(WORDS(r["text"] or ""))) for r in got) == Counter(
                {(k[0], tuple(WORDS(k[3]))): n for k, n in want.items()})
        elif name == "mixing":
            total = sum(len(WORDS(r["text"])) for r in rows)
            assert abs(sum(len(WORDS(r["text"])) for r in got) - 1.5 * total) <= 25
        if name != P.STAGES[-1][0]:
            assert out.columns == columns
            docs, rows = spark.createDataFrame(got, out.schema), got
    assert sorted(out.columns) == ["decoded_sha256", "doc_id", "ids_sha256", "n_tokens"] and len(got) == len(rows)


def test_awkward_and_empty_documents(spark):
    for docs in (frame(spark), frame(spark, [])):
        for _, step in P.STAGES:
            columns = docs.columns
            docs = step(spark, docs, SF_SMALL)
        assert columns == frame(spark, []).columns
        docs.collect()


def test_stage_names_and_functions():
    assert [n for n, _ in P.STAGES] == ["quality rules", "near-dedup", "passage dedup", "mixing", "tokens"]
    assert P.ORACLE_SQL is None
