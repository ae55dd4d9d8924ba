"""Small documents with every awkward case, and brute-force versions."""

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "n_words bigint, kept boolean, row string, _text string, mix_size int, spans int, label int, _id int, score int")


def vocabulary(n=400, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randrange(2, 9))) for _ in range(n)]


def awkward(seed=2):
    """(doc_id, text, lang, source, n_chars, clashing columns ...) rows."""
    rng, vocab = random.Random(seed), vocabulary()
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base, passage = text(120), text(90)
    near = base.split(" ")
    near[60] = "changed"
    docs = [
        (5, base, "en", "a"), (3, base, "en", "a"), (8, " ".join(near), "en", "b"),
        (1, text(40) + "\n" + passage + " " + text(30), "fr", "b"), (2, passage, "fr", None), (9, text(60) + " " + passage, None, "a"),
        (None, base, "en", "a"), (None, None, None, None), (10, None, "en", "c"), (11, "", "de", "c"), (12, " \t\n ", "de", "c"),
        (13, "one", "es", "c"), (14, "one two three", "es", "c"), (14, "one two three", "es", "c"),  # a repeated row
        (15, "x" * 5000, "en", "b"), (16, text(6000), "en", "b"),  # very long word, very long text
        (17, "spam " * 300, "en", "b"), (18, "idiot " + text(80), "en", "a"), (19, "line a\nline a\n\nline b #$ <x>\r\n", "en", "d"),
        (20, "日本 語 😀 é " * 30, "en", "d"), (21, "a<|endoftext|>b", "en", "d"),
    ]
    docs += [(100 + i, text(rng.randrange(50, 90)), "en", rng.choice("ab")) for i in range(30)]
    return [(i, t, la, s, len(t or ""), 7, False, "row", "_t", 3, 4, 1, 2, 0) for i, t, la, s in docs]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
