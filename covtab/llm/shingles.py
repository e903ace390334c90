"""Sets of word shingles as 64-bit hashes, and SuperMinHash signatures."""

from __future__ import annotations

import numpy as np

from covtab.llm.textcore import ASCII_LOWER, mix64, segment_hashes, words

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int
                 ) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of ``size`` consecutive words of every row, after
    lower-casing A-Z: hashes, sorted within each row, and the first of each
    row. A row with fewer words has its whole sequence as the one shingle; a
    row without words has none."""
    lower = ASCII_LOWER[data]
    start, end, first = words(lower, offsets)
    n = np.diff(first)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = segment_hashes(lower, start, end)
    # A running hash over the words, restarted at each place: shingles of up
    # to ``size`` words of one row.
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), count)
    upto = np.concatenate(([0], np.cumsum(count)))
    at = first[:-1][row] + np.arange(upto[-1]) - upto[:-1][row]
    width = np.minimum(n, size)[row]
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        live = width > k
        h[live] = mix64(h[live] * np.uint64(3) + word[at[live] + k] + np.uint64(k + 1))
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(offsets)))


def set_digests(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each row's set; with the set's size
    they identify it."""
    out = []
    for salt in (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)):
        acc = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix64(hashes ^ salt), out=acc[1:])
        out.append((acc[first[1:]] - acc[first[:-1]]).view(np.int64))
    return out[0], out[1]


def super_minhash(hashes: np.ndarray, first: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash signatures, ``rows x m``; of an empty set all infinite.

    Every element draws its own permutation of the ``m`` positions and offers
    ``rank + uniform`` to the position that each rank leads to; a position
    keeps its least offer. Ranks are taken level by level for all sets of the
    slice. A set is done, and its elements drop out, once its largest kept
    value is below the next rank: no later offer could win."""
    rows = len(first) - 1
    sig = np.full(rows * m, np.inf)
    if not len(hashes):
        return sig.reshape(rows, m)
    row = np.repeat(np.arange(rows), np.diff(first))
    state = hashes.copy()
    perm = None
    for rank in range(m):
        state = state + _STEP
        draw = mix64(state)
        # Fisher-Yates: swap position ``rank`` with one not yet passed.
        pick = rank + ((draw >> np.uint64(40)) * np.uint64(m - rank)
                       >> np.uint64(24)).astype(np.int64)
        if perm is None:
            place, swapped = pick, pick
        else:
            i = np.arange(len(row))
            place = perm[i, pick].astype(np.int64)
            perm[i, pick] = perm[:, rank]
        offer = rank + (mix64(draw) >> np.uint64(11)) * 2.0 ** -53
        np.minimum.at(sig, row * m + place, offer)
        open_ = (sig.reshape(rows, m).max(axis=1) >= rank + 1)[row]
        if not open_.any():
            break
        row, state = row[open_], state[open_]
        if perm is None:
            perm = np.tile(np.arange(m, dtype=np.int16), (len(row), 1))
            i, swapped = np.arange(len(row)), swapped[open_]
            perm[i, swapped] = perm[:, 0]
        else:
            perm = perm[open_]
    return sig.reshape(rows, m)


def band_hashes(sig: np.ndarray, bands: int, width: int) -> np.ndarray:
    """``rows x bands``: a hash of each band's ``width`` values and its number."""
    bits = np.ascontiguousarray(sig[:, :bands * width]).view(np.uint64)
    h = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), 1))
    for k in range(width):
        h = mix64(h * np.uint64(3) + bits[:, k::width][:, :bands])
    return h.view(np.int64)
