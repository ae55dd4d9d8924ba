"""BPE encoding and decoding with a pair occurrence index.

Within a task, the words not seen before are laid out as one array of
symbols; an index maps every adjacent pair to all its positions, the active
pair of the lowest rank is applied at all its positions from left to right,
and only the neighbours' entries change.  Words already merged are looked up.
The tokenizer file's path is a parameter; every executor opens its own
installed copy.
"""

from __future__ import annotations

import functools
import heapq
import json
import struct
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType

from tokenizers import normalizers, pre_tokenizers

from cumulo.llm import textbuf as tb
from cumulo.llm.common import free_name

_LITTLE = sys.byteorder == "little"

#: Words a task remembers before it starts anew (memory bound).
MEMORY_WORDS = 600_000


def _byte_chars() -> list[str]:
    """The printable stand-in of every byte: itself if it is printable Latin-1
    (no space, no soft hyphen), else the next code point from 256 on."""
    shown = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Bpe:
    """Word-level BPE with word-end suffix, as one tokenizer file describes it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.token = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: t for t, i in self.special.items()}
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # \s means Unicode white space there
        self.pattern = split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.pieces = regex.compile(self.pattern).findall
        self.marks = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        chars = _byte_chars()
        self.inner = [self.vocab[c] for c in chars]
        self.last = [self.vocab[c + self.end] for c in chars]
        self.strings = [self.token.get(i, "") for i in range(max(self.token) + 1)]
        self.known: dict[str | int, bytes] = {}

    def merge(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word, by one pair occurrence index over all words."""
        symbols: list[int] = []
        first: list[int] = []
        for w in words:
            raw = w.encode("utf-8")
            first.append(len(symbols))
            symbols += [self.inner[b] for b in raw[:-1]]
            symbols.append(self.last[raw[-1]])
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for at in first:  # words don't touch
            before[at] = -1
            if at:
                after[at - 1] = n
        places: dict[tuple[int, int], list[int]] = {}
        for i in range(n):
            if after[i] < n:
                places.setdefault((symbols[i], symbols[after[i]]), []).append(i)
        ranks = self.ranks
        active = [(ranks[p][0], p) for p in places if p in ranks]
        heapq.heapify(active)
        while active:
            _, pair = heapq.heappop(active)
            a, b = pair
            merged = ranks[pair][1]
            for i in sorted(places.pop(pair, ())):
                j = after[i] if symbols[i] == a else n
                if j >= n or symbols[j] != b:
                    continue  # an earlier merge took a part of it
                k = after[j]
                symbols[i], symbols[j], after[i] = merged, -1, k
                if k < n:
                    before[k] = i
                for left, right in ((before[i], i), (i, k)):
                    if left >= 0 and right < n:
                        new = symbols[left], symbols[right]
                        if new in ranks:
                            if new not in places:
                                places[new] = []
                                heapq.heappush(active, (ranks[new][0], new))
                            places[new].append(left)
        out = []
        for at, w_end in zip(first, [*first[1:], n]):
            out.append([s for s in symbols[at:w_end] if s >= 0])
        return out

    def learn(self, words: set[str]) -> None:
        """Merge the words not known yet."""
        if len(self.known) + len(words) > MEMORY_WORDS:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        for w, ids in zip(new, self.merge(new)):
            self.known[w] = struct.pack(f"<{len(ids)}I", *ids)

    def decode(self, ids) -> str:
        """The tokens' strings joined by one space (the file names no decoder)."""
        strings = self.strings
        return " ".join([strings[i] for i in ids])

    def split(self, text: str) -> list[str | int]:
        """Words and ids of special tokens of a text, in order."""
        out: list[str | int] = []
        at = 0
        for m in self.marks.finditer(text):
            out += self._plain(text[at:m.start()])
            out.append(self.special[m.group()])
            at = m.end()
        return out + self._plain(text[at:]) if at else self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if _BEYOND.search(text):
            normalize, pieces = self._exact
            return pieces(normalize(text))
        text = unicodedata.normalize("NFC", text)
        # lower case by single characters: no final sigma
        return self.pieces(text.replace("Σ", "σ").lower())

    @functools.cached_property
    def _exact(self):
        """Normaliser and splitter for scripts whose letters, digits or case
        differ between Unicode versions: the classes are read from the
        tokenizers library, so both agree on every code point."""
        every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
        pattern = self.pattern
        for cls in (r"\p{L}", r"\p{N}"):
            split = pre_tokenizers.Split(tokenizers.Regex(cls), "removed", invert=True)
            theirs = {p for p, _ in split.pre_tokenize_str(every)}
            newer = [ord(c) for c in regex.findall(cls, every) if c not in theirs]
            if newer:  # as character ranges
                edge = [i for i in range(len(newer)) if i == 0 or newer[i] != newer[i - 1] + 1]
                spans = [(newer[i], newer[j - 1]) for i, j in zip(edge, [*edge[1:], len(newer)])]
                without = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)
                pattern = (pattern.replace(f"[{cls}]", f"[{cls}--[{without}]]")
                           .replace(f"{cls}\\p", f"[{cls}--[{without}]]\\p").replace(f"{cls}]", f"[{cls}--[{without}]]]"))
        normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        return normal.normalize_str, regex.compile(pattern, regex.V1).findall

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        split = [self.split(t) for t in texts]
        self.learn({w for pieces in split for w in pieces if isinstance(w, str)})
        known = self.known
        for i in self.special.values():
            known[i] = struct.pack("<I", i)
        packed = [b"".join([known[w] for w in pieces]) for pieces in split]
        return [(p, self.decode(memoryview(p).cast("I") if _LITTLE else np.frombuffer(p, "<u4"))) for p in packed]


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


#: Code points below have had their classes and cases since Unicode 5.
_BEYOND = regex.compile("[^\\x00-\u0557]")

#: The pair index covers the new words of texts of about so many bytes at once.
CHUNK_BYTES = 1_000_000


def encode(docs: DataFrame, path: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus ``n_tokens``, ``ids`` (binary: little-endian
    unsigned 32-bit integers, as packed token files hold them) and ``decoded``
    (the ids decoded again, special tokens kept) of every whole text.

    Null text counts as empty: no ids, decoded ''.  Repeated rows give
    repeated results, an empty table an empty one.  Results take the place of
    kept columns of their names.  No shuffle.
    """
    keep = [c for c in keep if c.lower() not in ("n_tokens", "ids", "decoded")]
    rows = docs.select(*keep, F.col(text_col).alias(free_name(keep, "_text")))
    schema = (docs.select(*keep).schema.add("n_tokens", LongType())
              .add("ids", BinaryType()).add("decoded", StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for part in tb.slices(batch, len(keep), CHUNK_BYTES):
                done = bpe.encode([t or "" for t in part.column(len(keep)).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([len(i) // 4 for i, _ in done], pa.int64()),
                     pa.array([i for i, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())],
                    names=[*part.schema.names[:-1], "n_tokens", "ids", "decoded"])
        bpe.known.clear()  # workers live on: the next task may be another stage's
        tb.release()

    return rows.mapInArrow(run, schema)
