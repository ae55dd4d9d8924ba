"""Secret scan: fixed patterns, and the guess cost of credential values.

Patterns find assignments, access keys and hexadecimal strings.  The method
adds values in credential contexts (a key word such as ``password`` or
``login``, a separator, a value) that are hard to guess: a dynamic programme
finds the cheapest segmentation of a value into words, dates, repeats, keyboard
walks and brute-force spans; the sum of the segments' costs is the value's, in
powers of ten of guesses.  What counts as a word is what all documents hold:
a word costs the more the rarer it is.  Only the words that may stand inside a
value are needed, so values' letter runs are joined with the corpus' word
counts; no word list is collected or broadcast.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cumulo.llm import textbuf as tb
from cumulo.llm.common import stage

# Fixed by the task.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Credential context: a key word that does not go on as a word, a separator, a
#: value in quotes or up to white space or closing punctuation.
CONTEXT = re.compile(
    r"""(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|login|auth(?:orization)?|bearer"""
    r"""|(?:api|access|private|secret|client)[_\x20-]?(?:key|secret|token))(?![a-z])"""
    r"""["']?\x20*(?::=|=>|->|[:=]|\x20is\x20)\x20*(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"',;()<>{}\[\]]+))""", re.A | re.I)

#: A value that takes 10**10 guesses or more is a secret.
THRESHOLD = 10.0
#: Letters of a word inside a value, and what each segment costs besides.
SHORTEST, LONGEST_WORD, SEGMENT = 3, 20, 0.3
#: Words counted in a task before they are handed on.
MOST_WORDS = 300_000

_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz")
_NEXT = {pair: step for row in _ROWS for step, order in ((1, row), (-1, row[::-1])) for pair in zip(order, order[1:])}
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                   r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)?\d\d|(?:19|20)\d\d")
_LETTERS = re.compile(r"[^\W\d_]{%d,}" % SHORTEST)
_CLASSES = ((re.compile(r"\d"), 10), (re.compile(r"[a-z]"), 26), (re.compile(r"[A-Z]"), 26), (re.compile(r"[^A-Za-z0-9]"), 33))


def patterns(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind as listed."""
    found = []
    for at, (kind, pattern, group) in enumerate(zip(KINDS, (ASSIGN, ACCESS, HEX), (2, 0, 0))):
        found += [(m.start(), at, m.end(), kind) for m in pattern.finditer(text) if len(m.group(group)) >= LEAST[kind]]
    return [(start, end, kind) for start, _, end, kind in sorted(found)]


def values(text: str) -> list[tuple[int, int]]:
    """(start, end) of values in credential contexts."""
    return [m.span(m.lastindex) for m in CONTEXT.finditer(text)]


def inner_words(value: str) -> list[tuple[int, int]]:
    """(start, end) of everything in a value that may be a word: any part of
    3 to 20 letters of a run of letters."""
    spans = []
    for m in _LETTERS.finditer(value):
        for a in range(m.start(), m.end() - SHORTEST + 1):
            spans += [(a, b) for b in range(a + SHORTEST, min(a + LONGEST_WORD, m.end()) + 1)]
    return spans


def word_cost(word: str, share: float) -> float:
    """A word that is this share of all words; capitals are tried in turn."""
    capitals = sum(c.isupper() for c in word)
    shift = 0.0 if not capitals else math.log10(2) if capitals == len(word) or word[0].isupper() and capitals == 1 \
        else math.log10(math.comb(len(word), min(capitals, len(word) - capitals)) + 1)
    return max(0.0, -math.log10(share)) + shift


def _runs(value: str, step) -> list[tuple[int, int, object]]:
    """Maximal runs of three or more characters whose neighbours have one ``step``."""
    out, at = [], 0
    while at < len(value) - 1:
        s = step(value[at], value[at + 1])
        end = at + 2
        while s is not None and end < len(value) and step(value[end - 1], value[end]) == s:
            end += 1
        if s is not None and end - at >= 3:
            out.append((at, end, s))
            at = end - 1
        else:
            at += 1
    return out


def segments(value: str, shares: dict[str, float]):
    """(start, end, cost) of every word, date, repeat and keyboard walk of a
    value; ``shares``: how often lower-case words occur, by word."""
    found = [(a, b, word_cost(value[a:b], shares[value[a:b].lower()])) for a, b in inner_words(value)
             if value[a:b].lower() in shares]
    for at in range(len(value)):
        m = _DATE.match(value, at)
        if m:
            year = re.search(r"(?:19|20)\d\d", m.group())
            span = math.log10(max(abs(int(year.group()) - 2000), 20) if year else 100)
            found.append((at, m.end(), span + (0.0 if m.end() - at == 4 else math.log10(365.25))))
    for a, b, _ in _runs(value, lambda x, y: 0 if x == y else None):
        found.append((a, b, math.log10(_size(value[a:b]) * (b - a))))
    low = value.lower()
    for a, b, _ in _runs(low, lambda x, y: _NEXT.get((x, y))):
        found.append((a, b, math.log10(2 * sum(map(len, _ROWS)) * (b - a))))
    return found


def _size(span: str) -> int:
    return sum(n for pattern, n in _CLASSES if pattern.search(span))


def guess_cost(value: str, shares: dict[str, float]) -> float:
    """log10 of the guesses of the cheapest segmentation.

    A brute-force span costs log10 of its alphabet for every character; the
    alphabet is that of the whole value."""
    each = math.log10(max(_size(value), 2))
    ending: dict[int, list[tuple[int, float]]] = {}
    for a, b, cost in segments(value, shares):
        ending.setdefault(b, []).append((a, cost))
    brute, best = [SEGMENT], [0.0]  # cheapest up to here, the last span being brute force, and of all
    for at in range(1, len(value) + 1):
        span = min(brute[-1], best[-1] + SEGMENT) + each
        brute.append(span)
        best.append(min([span, *(best[a] + SEGMENT + cost for a, cost in ending.get(at, ()))]))
    return best[-1]


def scan(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``base`` (spans of the fixed patterns) and ``values``
    (spans and texts in credential contexts) of every document."""
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    names = rows.columns[:-1]
    schema = StructType([*rows.drop("_text").schema.fields, *StructType.fromDDL(
        "base array<struct<start:int,end:int,kind:string>>, values array<struct<start:int,end:int,value:string>>").fields])
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    value_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, found = [], []
            for text in batch.column(len(keep)).to_pylist():
                text = text or ""
                base.append([{"start": a, "end": b, "kind": k} for a, b, k in patterns(text)])
                found.append([{"start": a, "end": b, "value": text[a:b]} for a, b in values(text)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(base, base_type), pa.array(found, value_type)], names=[*names, "base", "values"])

    return rows.mapInArrow(run, schema)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(``word``, ``n``) of the lower-case letter runs of all texts that may be
    words of a value; one row with a null word: how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str | None, int] = {None: 0}

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                             names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for part in tb.slices(batch, 0):
                coded = _letter_runs(part.column(0)).dictionary_encode()
                if not len(coded):
                    continue
                n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)).tolist()
                counts[None] = counts.get(None, 0) + len(coded)
                for w, k in zip(coded.dictionary.to_pylist(), n):
                    counts[w] = counts.get(w, 0) + k
                if len(counts) > MOST_WORDS:
                    yield emit()
        yield emit()
        tb.release()

    return docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x80:] = True  # letters beyond ASCII; other signs there make a word that no value has
_LETTER[ord("a"):ord("z") + 1] = True


def _letter_runs(texts: pa.Array) -> pa.Array:
    """Runs of letters of up to 20 (ASCII capitals lowered), as Arrow strings."""
    data, offs = tb.buffer(texts)
    data = tb.LOWER[data]
    inside = _LETTER[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin = offs[(offs > 0) & (offs < len(data))]
    first[begin] = inside[begin]
    last[begin - 1] = inside[begin - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    fit = (ends - starts >= SHORTEST) & (ends - starts <= 4 * LONGEST_WORD)
    starts, ends = starts[fit], ends[fit]
    mark = np.zeros(len(data) + 1, np.int32)
    mark[starts] += 1
    mark[ends] -= 1  # an end may be the next one's start: both add up
    used = np.cumsum(mark[:-1]) > 0
    places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[used])))


def costs(found: DataFrame, words: DataFrame) -> DataFrame:
    """(``value``, ``cost``) of distinct values, from the corpus' word counts."""

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                spans = sorted({value[a:b].lower() for a, b in inner_words(value)})
                for at in range(0, len(spans), 100_000):
                    part = spans[at:at + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([value] * len(part), pa.string()), pa.array(part, pa.string())],
                                                     names=["value", "word"])

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cost = [guess_cost(v, {x["word"]: x["share"] for x in shares or ()})
                    for v, shares in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cost, pa.float64())], names=["value", "cost"])

    total = words.filter("word is null").agg(F.sum("n")).first()[0] or 1  # one number
    known = words.filter("word is not null").select("word", (F.col("n") / F.lit(float(total))).alias("share"))
    parts = stage(found.mapInArrow(inside, "value string, word string"), "value-words")
    # a word's row is met by every value that holds it: staged, so that AQE
    # may split a hot word
    shares = (stage(parts.join(known, "word"), "value-shares").groupBy("value")
              .agg(F.collect_list(F.struct("word", "share")).alias("shares")))
    return found.join(shares, "value", "left").select("value", "shares").mapInArrow(price, "value string, cost double")


def find_secrets(docs: DataFrame, keep: list[str], threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``keep`` columns plus ``base`` (array of start, end, kind of the fixed
    patterns, by start, then kind) and ``guessed`` (array of start, end, cost:
    values in credential contexts that take 10**threshold guesses or more).
    Places count code points, ends are exclusive.

    Null texts count as empty: no spans.  Repeated rows get repeated results.
    An empty table gives an empty one.  The columns kept may have any name.
    """
    names = [f"_keep{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text_col).alias("_text"))
    scanned = stage(scan(rows, names, "_text").withColumn("_row", F.monotonically_increasing_id()), "secret-scan")
    spans = scanned.filter(F.size("values") > 0).select("_row", F.explode("values").alias("v")).select("_row", "v.*")
    found = stage(spans.select("value").distinct(), "credential-values")
    words = stage(word_counts(rows, "_text"), "corpus-words")
    strong = stage(costs(found, words).filter(F.col("cost") >= threshold), "strong-values")
    added = (spans.join(strong, "value").groupBy("_row")
             .agg(F.sort_array(F.collect_list(F.struct("start", "end", "cost"))).alias("guessed")))
    done = scanned.join(stage(added, "guessed-spans"), "_row", "left")
    none = F.array().cast("array<struct<start:int,end:int,cost:double>>")
    return done.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "base", F.coalesce("guessed", none).alias("guessed"))
