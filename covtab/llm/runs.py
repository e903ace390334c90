"""Periodic runs of words, by string synchronising sets.

A run is a maximal stretch of words with smallest period ``q`` and a length of
at least ``3 * q``. Periods up to ``SMALL`` are found by comparing the words
with themselves moved by each of them. For larger ones, scales of length ``t``
(a power of two) follow; scale ``t`` answers for periods from ``1.5 t`` to
``3 t - 1``:

1. Every window of ``t`` words has a hash. Windows of a period of ``t / 3`` or
   less are left out: they lie in runs of smaller periods, known by then.
2. A position belongs to the synchronising set if, among the windows that start
   at most ``t`` words on, the least hash is that of the first or of the last.
   Only the next ``2 t`` words decide that, so equal contexts agree; and a gap
   of ``t`` positions occurs only in highly periodic text.
3. In a run of a period of this scale, some position of the set and the one a
   period later both have their contexts inside the run. Positions of equal
   context are more than ``t / 3`` apart, so the next ``NEXT`` of the same
   context hold it. Each such pair proposes its distance as a period.
4. A proposal is extended both ways as far as the words repeat; binary search
   over hashes finds how far, and the words themselves confirm it. Stretches
   found with several periods keep the smallest.

So no run is missed and none is made up, whatever hashes collide: words are
told apart by 64-bit hashes, all else is compared. The texts of a slice are one
string with a distinct word between any two, so that no run crosses them.

Cases: null, empty and blank texts have no words and no runs; a very long text
is worked on as a whole, in memory proportional to its words; repeated rows
each have their runs; ties in length or period do not arise within one stretch;
an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covtab.llm.textcore import mix64, powers, ranges, text_slices, word_hashes, words

MIN_WORDS = 24
MIN_PERIODS = 3
SMALL = 11
NEXT = 9
_FIRST_SCALE = 8
_NONE = np.uint64(2 ** 64 - 1)
_BLOCK_WORDS = 1 << 16

# (doc_id, n) -> the word that stands at each of the n places, or None.
Rearrange = Callable[[int | None, int], np.ndarray | None]


class _Words:
    """Word hashes with prefix sums, by which any two stretches compare."""

    def __init__(self, w: np.ndarray):
        self.w, self.n = w, len(w)
        self.power, self.inverse = powers(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(w * self.power[:self.n], out=self.sums[1:])

    def windows(self, at: np.ndarray | None, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each position, or from all."""
        if at is None:
            return mix64((self.sums[length:] - self.sums[:-length])
                         * self.inverse[:self.n - length + 1])
        return mix64((self.sums[at + length] - self.sums[at]) * self.inverse[at])

    def common(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray, step: int) -> np.ndarray:
        """How many words from ``i`` and from ``j > i`` on agree, at most
        ``limit``; backwards, before them, where ``step`` is -1."""
        low, high = np.zeros(len(i), np.int64), limit.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            a, b = (i, j) if step > 0 else (i - mid, j - mid)
            same = ((self.sums[a + mid] - self.sums[a]) * self.power[j - i]
                    == self.sums[b + mid] - self.sums[b])
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def repeats(self, start: int, end: int, period: int) -> bool:
        return np.array_equal(self.w[start:end - period], self.w[start + period:end])


def _stretches(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each unbroken stretch of ascending positions."""
    cut = np.flatnonzero(np.diff(at) != 1)
    return at[np.concatenate(([0], cut + 1))], at[np.concatenate((cut, [len(at) - 1]))]


def _small_periods(w: np.ndarray) -> Iterator[np.ndarray]:
    for q in range(1, SMALL + 1):
        same = np.flatnonzero(w[q:] == w[:-q])
        if len(same) >= (MIN_PERIODS - 1) * q:
            first, last = _stretches(same)
            long = last - first + 1 >= (MIN_PERIODS - 1) * q
            yield np.stack((first[long], last[long] + 1 + q, np.full(long.sum(), q)), axis=1)


def _smallest(found: list[np.ndarray]) -> np.ndarray:
    """One row (start, end, smallest period) for each stretch."""
    rows = np.concatenate([np.zeros((0, 3), np.int64), *found])
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[new]


def _synchronising_set(text: _Words, t: int, known: np.ndarray) -> np.ndarray:
    hashes = text.windows(None, t)
    periodic = known[(3 * known[:, 2] <= t) & (known[:, 1] - known[:, 0] >= t)]
    if len(periodic):
        inside = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(inside, periodic[:, 0], 1)
        np.add.at(inside, periodic[:, 1] - t + 1, -1)
        hashes[np.cumsum(inside[:-1]) > 0] = _NONE
    least, width = hashes, 1
    while width < t:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    n = text.n - 2 * t + 1
    ahead = hashes[t:t + n]
    least = np.minimum(least[:n], ahead)
    return np.flatnonzero((least != _NONE) & ((least == hashes[:n]) | (least == ahead)))


def _proposals(text: _Words, t: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and proposed periods from pairs of equal context."""
    context = text.windows(at, 2 * t)
    order = np.argsort(context, kind="stable")
    at, context = at[order], context[order]
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(1, min(NEXT, len(at) - 1) + 1):
        apart = at[k:] - at[:-k]
        good = ((context[k:] == context[:-k])
                & (2 * apart >= 3 * t - 1) & (apart <= 3 * t - 1))
        places.append(at[:-k][good])
        periods.append(apart[good])
    return np.concatenate(places), np.concatenate(periods)


def _checked(text: _Words, start: int, end: int, period: int, at: int) -> tuple[int, int]:
    """The stretch around ``at`` that has the period, compared word by word if
    hashes misled."""
    if text.repeats(start, end, period):
        return start, end
    breaks = np.flatnonzero(text.w[:-period] != text.w[period:])
    k = int(np.searchsorted(breaks, at))
    if k < len(breaks) and breaks[k] == at:
        return at, at
    return (int(breaks[k - 1]) + 1 if k else 0,
            (int(breaks[k]) if k < len(breaks) else text.n - period) + period)


def find_runs(w: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Rows (start, end, period) of all runs in an array of word hashes, by
    start. ``longest`` bounds the length of any run."""
    longest = len(w) if longest is None else longest
    known = _smallest(list(_small_periods(w)))
    text, t = None, _FIRST_SCALE
    while MIN_PERIODS * (3 * t // 2) <= longest:
        text = text or _Words(w)
        at, period = _proposals(text, t, _synchronising_set(text, t, known))
        if len(at):
            end = at + period + text.common(at, at + period, text.n - at - period, 1)
            start = at - text.common(at, at + period, at, -1)
            long = end - start >= MIN_PERIODS * period
            first = np.flatnonzero(long)
            rows = np.stack((start, end, period, at), axis=1)[first]
            _, once = np.unique(rows[:, :3], axis=0, return_index=True)
            sure = [(*_checked(text, *rows[k]), int(rows[k, 2])) for k in once.tolist()]
            sure = [r for r in sure if r[1] - r[0] >= MIN_PERIODS * r[2]]
            if sure:
                known = _smallest([known, np.array(sure, np.int64)])
        t *= 2
    return known


def _slice_runs(word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of at least ``MIN_WORDS`` of the rows of a slice: the row of each,
    and (start, end, period) within it."""
    n = np.diff(first)
    rows = len(n)
    joined = np.empty(len(word) + rows, np.uint64)
    begin = first[:-1] + np.arange(rows)
    gaps = first[1:] + np.arange(rows)
    joined[gaps] = mix64(np.arange(rows, dtype=np.uint64) + np.uint64(0xC2B2AE3D27D4EB4F))
    inside = np.ones(len(joined), bool)
    inside[gaps] = False
    joined[inside] = word
    found = find_runs(joined, int(n.max(initial=0)))
    found = found[found[:, 1] - found[:, 0] >= MIN_WORDS]
    row = np.searchsorted(begin, found[:, 0], side="right") - 1
    found[:, :2] -= begin[row][:, None]
    return row, found


def _joined_text(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> str:
    """The given words with one space between them."""
    parts = []
    for k in range(0, len(start), _BLOCK_WORDS):
        s, size = start[k:k + _BLOCK_WORDS], (end - start)[k:k + _BLOCK_WORDS] + 1
        block = data.take(ranges(s, size), mode="clip")
        block[np.cumsum(size) - 1] = 0x20
        parts.append(block.tobytes())
    return b"".join(parts)[:-1].decode()


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, rearrange: Rearrange | None = None) -> DataFrame:
    """Per document: ``doc_id``, ``runs`` (array of start, length, period, by
    start; of at least ``MIN_WORDS`` words) and ``collapsed``, the words joined
    by one space without those that a run holds after its first period.
    ``rearrange`` may name another word for each place before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column("text")):
                start, end, first = words(data, offsets)
                ids = batch.column("doc_id").slice(i, j - i)
                source = np.arange(len(start))
                if rearrange is not None:
                    for r, doc_id in enumerate(ids.to_pylist()):
                        a, b = first[r], first[r + 1]
                        order = rearrange(doc_id, int(b - a)) if b > a else None
                        if order is not None:
                            source[a:b] = a + order
                row, found = _slice_runs(word_hashes(data, start, end)[source], first)
                kept = np.zeros(len(source) + 1, np.int64)
                np.add.at(kept, first[row] + found[:, 0] + found[:, 2], 1)
                np.add.at(kept, first[row] + found[:, 1], -1)
                kept = np.cumsum(kept[:-1]) == 0
                texts = []
                for r in range(j - i):
                    own = source[first[r]:first[r + 1]][kept[first[r]:first[r + 1]]]
                    texts.append(_joined_text(data, start[own], end[own]))
                lists = pa.StructArray.from_arrays(
                    [pa.array(found[:, 0]), pa.array(found[:, 1] - found[:, 0]),
                     pa.array(found[:, 2])], fields=list(_RUN))
                upto = np.searchsorted(row, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.ListArray.from_arrays(pa.array(upto, pa.int32()), lists),
                     pa.array(texts, pa.string())], ["doc_id", "runs", "collapsed"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, runs array<struct<start: long, length: long, "
                             "period: long>>, collapsed string"))


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's rearrangement: of every tenth doc_id (by crc32), the words
    from a place on repeat with a period. A null doc_id stays as it is."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def _greatest(runs: Column) -> Column:
    """The run of greatest length / period, null if there is none. Of equal
    ones the first stays: by start, then period, as they are ordered."""
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.try_element_at(runs, F.lit(1)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r)
        .otherwise(best))


def run_digests(found: DataFrame) -> DataFrame:
    """What ``periodic_runs`` found, a row of numbers and digests a document."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = found.withColumn("best", _greatest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.expr("best.length * 1000 div best.period")).cast("long")
        .alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
