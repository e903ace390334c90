"""Language identification by rank-order profiles of character n-grams.

A profile lists the ``PROFILE`` most frequent n-grams of 1 to ``MAX_N``
characters of a language, by rank; words are lower-cased letters with a blank
on either side. A text's own list is compared to each profile: every n-gram
adds how far its rank is out of place, or ``PROFILE`` if the profile lacks it.
The nearest profile wins. ``keep_known`` rejects a text that is far from every
profile: its mean distance an n-gram, as a share of ``PROFILE``, exceeds
``FARTHEST`` plus ``1 / sqrt(n)`` for its ``n`` n-grams, two standard
deviations of such a mean at most. Whole texts of learned languages lie below
0.6, random letters of a learned script near 0.8, unlearned scripts at 1.

Profiles are learned from text and language of training documents only
(``is_training``), at most about ``TRAIN_DOCS`` a language, chosen by a hash
of doc_id against the language's share; each language's counts cover all text
of its chosen documents.

Cases: null texts and texts without a letter are ``und`` with score 0; ties
between n-grams go to the smaller code, between languages to the smaller name;
a very long text is worked on as a whole, in memory proportional to it; repeated
rows are predicted each, and null doc_ids too, with a null held_out; without
training documents every text is ``und``, and ``keep_known`` keeps all that hold
a letter; columns other than doc_id, text and lang are not read by training and
prediction, ``keep_known`` hands all through; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covtab.llm.textcore import text_slices

MAX_N = 3
PROFILE = 400
TRAIN_DOCS = 1_000  # of each language, about; bounds the training texts
SLICE = 1 << 17  # bytes of text whose n-grams a task holds at once
FARTHEST = 0.7  # mean distance an n-gram, as a share of PROFILE, of a known text
UNKNOWN = "und"
_BITS = 21  # of a code point
_BLANK = 0x20


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The lower-case form of each code point that is a letter, else 0."""
    out = np.zeros(0x110000, np.int32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def _ranked(codes: np.ndarray, rows: int, row: np.ndarray, top: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, n-gram and rank of each row's ``top`` most frequent n-grams."""
    order = np.lexsort((codes, row))
    codes, row = codes[order], row[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(codes)))
    codes, row = codes[at], row[at]
    order = np.lexsort((codes, -count, row))
    codes, row = codes[order], row[order]
    rank = np.arange(len(row)) - np.searchsorted(row, np.arange(rows))[row]
    keep = rank < top
    return row[keep], codes[keep], rank[keep]


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of a slice's rows as integers, and their rows. An n-gram of
    ``n`` characters is their code points side by side; a word's blanks count
    as characters, but no n-gram is a blank alone."""
    text = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    edges = chars[offsets]
    low = _letters()[text]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(edges))
    # Words in a row of letters, each led by a blank; a blank ends the slice.
    letter = low > 0
    first = letter.copy()
    first[1:] &= ~letter[:-1] | (row[1:] != row[:-1])
    size = np.where(letter, 1 + first, 0)
    put = np.cumsum(size)
    total = int(put[-1]) if len(put) else 0
    x = np.full(total + 1, _BLANK, np.int64)
    at_row = np.zeros(total + 1, np.int64)
    x[put[letter] - 1] = low[letter]
    at_row[put[letter] - 1] = row[letter]
    at_row[put[first] - 2] = row[first]
    at_row[total] = len(offsets) - 1
    blank = x[:-1] == _BLANK
    # The blank after a word is the one before the next word, or the last one.
    single, parts, rows = ~blank, [], []
    parts.append(x[:-1][single])
    rows.append(at_row[:-1][single])
    for n in range(2, MAX_N + 1):
        if total + 1 < n:
            break
        code = x[:total + 2 - n].copy()
        inner = np.ones(len(code), bool)
        for k in range(1, n):
            code = (code << _BITS) | x[k:total + 2 - n + k]
            if k < n - 1:
                inner &= x[k:total + 2 - n + k] != _BLANK
        parts.append(code[inner])
        # One that starts at the blank before a word belongs to that word.
        rows.append(at_row[:len(code)][inner])
    return np.concatenate(parts), np.concatenate(rows)


def _profile_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang = np.array(batch.column("lang").to_pylist(), object)
        for i, j, data, offsets in text_slices(batch.column("text"), SLICE):
            codes, row = _grams(data, offsets)
            for name in sorted(set(lang[i:j])):
                mine = (lang[i:j] == name)[row]
                code, n = np.unique(codes[mine], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(code)), pa.array(code), pa.array(n)],
                    ["lang", "code", "n"])


def train(docs: DataFrame, per_language: int = TRAIN_DOCS, profile: int = PROFILE
          ) -> dict[str, np.ndarray]:
    """Ranked n-grams of every language. The driver gets ``profile`` rows for
    each language."""
    fit = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
           .where(~is_held_out(F.col("doc_id")))
           .select("doc_id", F.col("lang").cast("string").alias("lang"),
                   F.col("text").cast("string").alias("text")))
    counts = {r["lang"]: r["n"] for r in fit.groupBy("lang").agg(F.count("*").alias("n"))
              .collect()}
    if not counts:
        return {}
    # A language's share of the hash's range, by its count of documents.
    limit = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n)))
                         for lang, n in sorted(counts.items())])
    share = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1_000_003)) / 1_000_003
    grams = (fit.where(share < limit).select("lang", "text")
             .mapInArrow(_profile_rows, "lang string, code long, n long")
             .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    # All languages in one job; each task cuts a language to its most frequent
    # n-grams before they meet.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    ranked: dict[str, list[tuple[int, int]]] = {}
    for r in (grams.withColumn("place", place).where(F.col("place") <= profile)
              .select("lang", "place", "code").collect()):
        ranked.setdefault(r["lang"], []).append((r["place"], r["code"]))
    return {lang: np.array([code for _, code in sorted(rows)], np.int64)
            for lang, rows in ranked.items()}


class Profiles:
    """Out-of-place distances to every language's profile."""

    def __init__(self, profiles: dict[str, np.ndarray]):
        self.names = sorted(profiles)
        size = max((len(p) for p in profiles.values()), default=0)
        self.size = size
        self.codes = np.unique(np.concatenate([profiles[x] for x in self.names] or
                                              [np.zeros(0, np.int64)]))
        self.rank = np.full((len(self.names), len(self.codes) + 1), -1, np.int64)
        for k, name in enumerate(self.names):
            self.rank[k, np.searchsorted(self.codes, profiles[name])] = np.arange(
                len(profiles[name]))

    def distances(self, data: np.ndarray, offsets: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray]:
        """``rows x languages`` distances, and the number of n-grams compared
        in each row."""
        rows = len(offsets) - 1
        code, row = _grams(data, offsets)
        row, code, rank = _ranked(code, rows, row, self.size)
        at = np.searchsorted(self.codes, code)
        found = at < len(self.codes)
        found[found] = self.codes[at[found]] == code[found]
        at[~found] = len(self.codes)
        out = np.zeros((rows, len(self.names)))
        for k in range(len(self.names)):
            place = self.rank[k, at]
            away = np.where(place < 0, self.size, np.abs(place - rank))
            out[:, k] = np.bincount(row, weights=away, minlength=rows)
        return out, np.bincount(row, minlength=rows)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row. The score is the nearest profile's
        lead over the next one: from 0.5 (even) to 1 (no distance at all)."""
        d, n = self.distances(data, offsets)
        if not self.names:
            return [UNKNOWN] * len(n), np.zeros(len(n))
        best = d.argmin(axis=1)
        first = d.min(axis=1)
        if len(self.names) > 1:
            second = np.partition(d, 1, axis=1)[:, 1]
        else:
            second = np.maximum(n * self.size, 1.0)
        score = np.where(n > 0, 0.5 + 0.5 * (1 - first / np.maximum(second, 1e-9)), 0.0)
        return [self.names[b] if k else UNKNOWN for b, k in zip(best, n, strict=True)], score

    def known(self, data: np.ndarray, offsets: np.ndarray, farthest: float) -> np.ndarray:
        """Whether each row is near enough to some profile to be of a language."""
        if not self.names:
            return np.bincount(_grams(data, offsets)[1], minlength=len(offsets) - 1) > 0
        d, n = self.distances(data, offsets)
        some = np.maximum(n, 1)
        return (n > 0) & (d.min(axis=1) / (some * self.size) <= farthest + 1 / np.sqrt(some))


def predict(docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (0 to 1) of every
    document."""
    model = Profiles(profiles)

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column("text"), SLICE):
                lang, score = model.predict(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i),
                     batch.column("held_out").slice(i, j - i), pa.array(lang),
                     pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        is_held_out(F.col("doc_id")).alias("held_out"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))


def keep_known(docs: DataFrame, profiles: dict[str, np.ndarray],
               farthest: float = FARTHEST) -> DataFrame:
    """The documents whose text has a language, columns unchanged: those near
    enough to a profile or, if none was learned, those with a letter."""
    columns, model = docs.columns, Profiles(profiles)

    def run(batches):
        for batch in batches:
            keep = [model.known(data, offsets, farthest)
                    for _, _, data, offsets in text_slices(batch.column("text"), SLICE)]
            yield batch.filter(pa.array(np.concatenate(keep or [np.zeros(0, bool)]), pa.bool_())
                               ).select(columns)
    return docs.mapInArrow(run, docs.schema)
