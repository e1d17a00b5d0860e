"""Vectorised text helpers shared by the Arrow operators.

An Arrow batch is cut into slices of a few megabytes of whole documents, and
each slice is handled as one byte buffer plus document offsets, so per-document
Python overhead stays small and memory is bounded by the slice (or by the
longest single document where that is larger).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

U64 = np.uint64
_MULT = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULT, -1, 1 << 64)


def binary(column: pa.Array) -> pa.Array:
    """Text column as UTF-8 bytes; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.fill_null("").cast(pa.large_binary()) if column.null_count else column.cast(pa.large_binary())


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive whole documents.

    ``offsets`` has one entry more than there are documents and starts at 0.
    """
    arr = binary(column)
    n = len(arr)
    if not n:
        return
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + limit, "right")) - 1)
        end = min(end, n)
        yield row, end, data[off[row]:off[end]], off[row:end + 1] - off[row]
        row = end


def byte_table(separators: bytes | set[int]) -> np.ndarray:
    """True for every byte that belongs to a word."""
    t = np.ones(256, bool)
    t[list(separators)] = False
    return t


#: Words are maximal runs of bytes other than space and \\t \\n \\v \\f \\r.
SPACE_WORDS = byte_table({0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D})
#: Words are maximal runs of ASCII digits, lower-case ASCII letters and non-ASCII.
ALNUM_WORDS = byte_table(set(range(0x30)) | set(range(0x3A, 0x61)) | set(range(0x7B, 0x80)))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """ASCII A-Z to lower case."""
    return _LOWER[data]


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII, the Latin letters of two bytes from U+00C0 on, and basic Cyrillic."""
    out = _LOWER[data]
    if len(out) < 2:
        return out
    lead, next_ = data[:-1], data[1:]
    latin = (lead == 0xC3) & (next_ >= 0x80) & (next_ <= 0x9E) & (next_ != 0x97)
    out[1:][latin | ((lead == 0xD0) & (next_ >= 0x90) & (next_ <= 0x9F))] += 32
    upper = np.flatnonzero((lead == 0xD0) & (next_ >= 0xA0) & (next_ <= 0xAF))
    out[upper], out[upper + 1] = 0xD1, out[upper + 1] - 32
    return out


def runs(flag: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each maximal run of True inside a document."""
    n = len(flag)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = flag[:-1]
    starts = np.flatnonzero(flag & (~before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = flag[1:]
    ends = np.flatnonzero(flag & (~after | cut[1:])) + 1
    docs = np.searchsorted(off, starts, "right") - 1
    return starts, ends, docs


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (multiply and shift)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: One random-looking 64-bit value per byte, from a rule.
GEAR = mix(np.arange(1, 257, dtype=U64) * U64(_MULT))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, U64)
    p[0] = 1
    return np.cumprod(p, dtype=U64)


def _table(base: int, n: int) -> np.ndarray:
    return _powers(base, max(SLICE_BYTES * 2, 1 << int(n).bit_length()))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span data[start:end]; spans are in ascending order."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        base = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        top = ends[stop - 1]
        n = int(top - base)
        total = np.zeros(n + 1, U64)
        np.cumsum(GEAR[data[base:top]] * _table(_MULT, n)[:n], out=total[1:])
        s, e = starts[at:stop] - base, ends[at:stop] - base
        out[at:stop] = mix((total[e] - total[s]) * _table(_INVERSE, n)[s] + (e - s).astype(U64))
        at = stop
    return out


def windows(words: np.ndarray, docs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word index of every k-word window inside one document."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    h = words[:n].copy()
    for i in range(1, k):
        h *= U64(_MULT)
        h += words[i:i + n]
        h ^= h >> U64(29)
    first = np.flatnonzero(docs[:n] == docs[k - 1:])
    return mix(h[first]), first


def per_doc(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (one per byte) within each document."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]
