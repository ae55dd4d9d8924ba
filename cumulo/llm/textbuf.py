"""Vectorised words and fingerprints over Arrow string columns.

A batch of texts is one byte buffer with offsets.  Words are maximal runs
of bytes other than space and ``\\x09-\\x0D`` (the separators are ASCII, so
this equals ``[^\\x20\\x09-\\x0D]+`` on the decoded text).  Fingerprints are
polynomial hashes mod 2**64 taken from one prefix sum over the buffer, so
the cost per byte does not depend on word or window length.  Everything
here works on one Arrow batch inside a task.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _tables(seed: int):
    rng = np.random.default_rng(seed)
    byte = rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
    base = int(rng.integers(2**40, 2**63)) * 2 + 1
    return byte, base, pow(base, -1, 2**64)


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` mod 2**64; grown by doubling and kept per worker."""
    have = _POWERS.get((base, 0))
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 23:  # longer ones are not worth keeping in memory
            _POWERS[(base, 0)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), on a copy."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    raw = column.buffers()
    if n == 0 or raw[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(raw[1], kind)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8)[offs[0]:offs[-1]] if raw[2] is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def words(data: np.ndarray, offs: np.ndarray):
    """(start, end, document index) of every word of the batch."""
    sep = _SEP[data]
    start, end = ~sep, ~sep
    start[1:] &= sep[:-1]
    end[:-1] &= sep[1:]
    inner = offs[(offs > 0) & (offs < len(data))]  # a word never crosses documents
    start[inner] = ~sep[inner]
    end[inner - 1] = ~sep[inner - 1]
    s = np.flatnonzero(start)
    e = np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offs, s, "right") - 1


class Rolling:
    """Fingerprints of any ``data[s:e]`` of one buffer from one prefix sum."""

    def __init__(self, data: np.ndarray, seed: int = 11):
        byte, self.base, self.inverse = _tables(seed)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(byte[data] * powers(self.base, len(data)), out=self.sums[1:])

    def of(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        shift = powers(self.inverse, len(self.sums))[s]
        return mix((self.sums[e] - self.sums[s]) * shift + (e - s).astype(np.uint64))


def window_hash(values: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of each run of ``width`` consecutive values (order counts)."""
    n = max(0, len(values) - width + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        out *= U64(0x9E3779B97F4A7C15)
        out += values[j:j + n]
    return mix(out)


def window_starts(doc: np.ndarray, width: int) -> np.ndarray:
    """Indices ``i`` whose run ``i .. i+width-1`` lies in one document."""
    n = max(0, len(doc) - width + 1)
    return np.flatnonzero(doc[:n] == doc[width - 1:width - 1 + n]) if n else np.zeros(0, np.int64)


def runs_of(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal neighbouring rows begin."""
    n = len(columns[0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def run_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the minimum of every run of ``width`` values, compared by
    their upper 32 bits; ties go to the left, so equal runs agree anywhere.

    The lower 32 bits give way to the position, so that one running minimum
    finds both.  Blocks of ``width`` values: a run is the end of one block and
    the beginning of the next.
    """
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    low = U64(0xFFFFFFFF)
    full = -(-n // width) * width
    block = np.full(full, ~U64(0))
    block[:n] = (values & ~low) | np.arange(n, dtype=np.uint64)
    block = block.reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n - width + 1], ahead[width - 1:n]) & low).astype(np.int64)


def release() -> None:
    """Give freed memory back to the system at the end of a task: Python
    workers are reused by later stages, and their heaps add up."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, text: int, most: int = 2_000_000):
    """``batch`` in row slices of about ``most`` bytes of its text column, so
    that numpy's work arrays stay bounded (one longer text is a slice alone)."""
    _, offs = buffer(batch.column(text))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(offs, offs[begin] + most, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


# byte classes: separator, lower (and any non-ASCII), upper, digit, other
_CLASS = np.full(256, 4, dtype=np.uint8)
_CLASS[_SEP] = 0
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[0x80:] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def tokens(data: np.ndarray, offs: np.ndarray):
    """(start, end, document index) of every token: words cut further where
    letters, digits and symbols meet (a capital may begin a lower-case word)."""
    kind = _CLASS[data]
    cut = np.ones(len(data) + 1, dtype=bool)
    if len(data):
        cut[1:-1] = (kind[1:] != kind[:-1]) & ~((kind[:-1] == 2) & (kind[1:] == 1))
        cut[offs] = True
    edge = np.flatnonzero(cut)
    s, e = edge[:-1], edge[1:]
    keep = kind[s] != 0
    s, e = s[keep], e[keep]
    return s, e, np.searchsorted(offs, s, "right") - 1
