"""Vectorised text primitives shared by the operators' Arrow tasks.

Everything here works on the UTF-8 bytes of a bounded slice of a batch, so a
task's memory follows the slice (``SLICE_BYTES``) and the longest single text,
never the batch or the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
LONG_BYTES = 1 << 21

# White space of the word rule shared by the word operators: space, \t..\r.
_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
# Lower-casing of A-Z only.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_pow: np.ndarray = np.ones(1, np.uint64)
_ipow: np.ndarray = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of each."""
    global _pow, _ipow
    if len(_pow) < n:
        size = max(n, 2 * SLICE_BYTES)
        _pow = np.concatenate(([np.uint64(1)], np.full(size - 1, _R))).cumprod()
        _ipow = np.concatenate(([np.uint64(1)], np.full(size - 1, _R_INV))).cumprod()
    return _pow, _ipow


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segment_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``data[start:end]``: a polynomial modulo 2**64 from
    prefix sums, finalised with the length. Equal bytes give equal hashes
    wherever they stand."""
    pw, ip = powers(len(data) + 1)
    acc = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * pw[:len(data)], out=acc[1:])
    h = (acc[end] - acc[start]) * ip[start]
    return mix64(h ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``segment_hashes`` of ascending words, taken some megabytes at a time."""
    if len(data) <= LONG_BYTES:
        return segment_hashes(data, start, end)
    out, k = np.empty(len(start), np.uint64), 0
    while k < len(start):
        j = max(k + 1, int(np.searchsorted(end, start[k] + LONG_BYTES, side="right")))
        lo = start[k]
        out[k:j] = segment_hashes(data[lo:end[j - 1]], start[k:j] - lo, end[k:j] - lo)
        k = j
    return out


def as_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def text_slices(col: pa.Array, limit: int = SLICE_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, bytes, offsets)`` of each slice of a column."""
    data, offsets = as_bytes(col)
    for i, j in slices(offsets, limit):
        o = offsets[i:j + 1]
        yield i, j, data[o[0]:o[-1]], o - o[0]


def words(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _WS
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of every row, and
    the first word of each row (``len(offsets)`` entries). ``gaps`` marks other
    bytes than those as the ones between words."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = ~gaps[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[(offsets > 0) & (offsets < n)]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edge - 1] = inside[edge - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets, side="left")


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The concatenation of ``start[i] .. start[i] + length[i] - 1``."""
    total = int(length.sum())
    base = np.cumsum(length) - length
    return np.repeat(start - base, length) + np.arange(total, dtype=np.int64)
