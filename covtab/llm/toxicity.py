"""Toxicity by a support vector machine over a subsequence string kernel.

Texts are cut into sentences and units. A unit is a word in lower case without
its inserted symbols; words of one character in a row are one unit, so
``i d i o t`` and ``id-iot`` read as one word. The kernel of two units counts
common subsequences of ``ORDER`` characters, each weighted by ``DECAY`` to the
length it spans (at most ``SPAN``), normalised to 1 for equal units: inserted
and missing characters lower it instead of hiding the word. A sentence is
compared to a landmark by its best unit; values below ``LEAST`` count as 0, a
cut that words of five letters and more pass with up to three inserted letters.

Landmarks are the units most associated with the toxic label. The Nyström map
whitens a sentence's values by the landmarks' kernel matrix: for a sentence of
one unit the features' inner products approximate the kernel, for others they
are those of its largest values. A linear support vector machine is trained on labelled sentences:
every sentence has its document's label, and after each fit a toxic document
is represented by its sentences that score above 0, or its best one. A
document's probability comes from its most toxic sentence and its share of toxic
ones, by logistic calibration.

The training sample is bounded: about ``TRAIN_DOCS`` documents of either
label, chosen by a hash of doc_id, and of each its ``TRAIN_SENTENCES`` sentences
nearest a landmark; ``may_learn`` shuts out held-out documents.
Scoring covers every sentence of every whole text.

Cases: null and empty texts have no sentence that resembles a landmark and get
the score of such; a very long text is worked on as a whole, in memory
proportional to it; repeated rows are scored each, and rows without a doc_id too,
with a null held_out; labels that disagree for a doc_id count as toxic; equal
log-odds go to the smaller unit; without labels of both kinds every score is 0;
an empty table gives no rows; only doc_id and text of a document are read,
whatever its other columns are, and doc_id never enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covtab.llm.scratch import staged
from covtab.llm.textcore import ranges, segment_hashes, text_slices

ORDER, SPAN, DECAY = 3, 9, 0.9
LEAST = 0.25
LANDMARKS = 96
MIN_DOCS = 2  # toxic documents that a landmark is seen in
TRAIN_DOCS = 2_000  # of either label, about; bounds the training texts
TRAIN_SENTENCES = 32  # of a document, nearest a landmark first; bounds the training rows
COST = 1.0
WITNESS_ROUNDS = 3
MEMO_UNITS = 200_000
UNIT_BLOCK = 512  # units compared to all landmarks at once
SCORE_SLICE = 1 << 18

_SYMBOLS = 64  # letters a-z, other letters and digits in the rest, 0 is none
_SPACE, _STOP, _DROP = 64, 65, 66
_OFFSETS = [(0, *c) for c in combinations(range(1, SPAN), ORDER - 1)]
_WEIGHTS = np.array([DECAY ** (pattern[-1] + 1) for pattern in _OFFSETS])


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


@lru_cache(maxsize=1)
def _symbol_table() -> np.ndarray:
    """Symbol of every code point: 1 to 26 for a-z, further ones for other
    letters and digits, or one of the marks."""
    out = np.full(0x110000, _DROP, np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()[0]
            out[cp] = ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % 36
        elif c.isdigit():
            out[cp] = 63
        elif c.isspace():
            out[cp] = _SPACE
    out[[ord(c) for c in "\n.!?"]] = _STOP
    return out


def symbols(text: str) -> np.ndarray:
    """The symbols of one unit."""
    s = _symbol_table()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    return s[s < _SPACE]


@dataclass
class Units:
    """Units of a slice: ``code[start:end]``, with their sentence; sentences
    are numbered over the slice, and ``row`` is each sentence's row."""
    code: np.ndarray
    start: np.ndarray
    end: np.ndarray
    sentence: np.ndarray
    row: np.ndarray


def cut_units(data: np.ndarray, offsets: np.ndarray) -> Units:
    text = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(chars[offsets]))
    s = _symbol_table()[text]
    # A full stop inside a word (before no space) is an inserted symbol.
    inner = s == _STOP
    after = np.append(s[1:], _SPACE)
    inner &= (after < _SPACE) & (text != 10)
    s = np.where(inner, _DROP, s)
    live = s != _DROP
    s, row = s[live], row[live]
    sign = s >= _SPACE
    new_row = np.ones(len(s), bool)
    new_row[1:] = row[1:] != row[:-1]
    stop_before = np.zeros(len(s), bool)
    stop_before[1:] = s[:-1] == _STOP
    sentence = np.cumsum(new_row | stop_before) - 1
    first = ~sign
    first[1:] &= sign[:-1] | new_row[1:]
    code, sentence_of, row_of = s[~sign], sentence[~sign], row[~sign]
    start = np.flatnonzero(first[~sign])
    end = np.append(start[1:], len(code)) if len(start) else start
    # Words of one character in a row of one sentence are one unit.
    if len(start):
        one = end - start == 1
        join = np.zeros(len(start), bool)
        join[1:] = one[1:] & one[:-1] & (sentence_of[start[1:]] == sentence_of[start[:-1]])
        start = start[~join]
        end = np.append(start[1:], len(code))
    numbers, unit_sentence = np.unique(sentence_of[start], return_inverse=True)
    at = np.searchsorted(sentence_of, numbers)
    return Units(code, start, end, unit_sentence, row_of[at] if len(at) else at)


def occurrences(code: np.ndarray, start: np.ndarray, end: np.ndarray
                ) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Unit, subsequence (as an integer) and weight of every occurrence in the
    given units, one pattern of gaps at a time."""
    size = end - start
    unit = np.repeat(np.arange(len(start)), size)
    c = code[ranges(start, size)].astype(np.int64)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(c))
    padded = np.concatenate((c, np.zeros(SPAN, np.int64)))
    for pattern in _OFFSETS:
        ok = left > pattern[-1]
        key = padded[:len(c)]
        for d in pattern[1:]:
            key = key * _SYMBOLS + padded[d:len(c) + d]
        yield unit[ok], key[ok], DECAY ** (pattern[-1] + 1)


def kernel_features(code: np.ndarray, start: np.ndarray, end: np.ndarray
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The normalised kernel's explicit features: unit, subsequence, value,
    sorted by unit and subsequence. Kernels are inner products of them."""
    parts = [(unit, key, np.full(len(unit), w)) for unit, key, w in
             occurrences(code, start, end)]
    unit, key, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
    full = unit * _SYMBOLS ** ORDER + key
    full, inverse = np.unique(full, return_inverse=True)
    value = np.bincount(inverse, weights=weight, minlength=len(full))
    unit, key = full // _SYMBOLS ** ORDER, full % _SYMBOLS ** ORDER
    norm = np.sqrt(np.bincount(unit, weights=value ** 2, minlength=len(start)))
    return unit, key, value / norm[unit]


def kernel(x: str, y: str) -> float:
    """The normalised kernel of two units."""
    parts = [symbols(x), symbols(y)]
    end = np.cumsum([len(p) for p in parts])
    unit, key, value = kernel_features(np.concatenate(parts), np.array([0, end[0]]), end)
    both = np.intersect1d(key[unit == 0], key[unit == 1], return_indices=True)
    return float(value[unit == 0][both[1]] @ value[unit == 1][both[2]])


class LandmarkKernel:
    """Kernel values of units against all landmarks."""

    def __init__(self, landmarks: list[bytes]):
        self.landmarks = landmarks
        code = np.frombuffer(b"".join(landmarks), np.uint8)
        end = np.cumsum([len(x) for x in landmarks])
        start = np.concatenate(([0], end[:-1])).astype(np.int64)
        unit, key, value = kernel_features(code, start, end.astype(np.int64))
        known = np.unique(key)
        self.place = np.zeros(_SYMBOLS ** ORDER, np.int32)  # 0: in no landmark
        self.place[known] = np.arange(1, len(known) + 1)
        self.values = np.zeros((len(known) + 1, len(landmarks)), np.float32)
        self.values[self.place[key], unit] = value
        self.most = self.values.max(axis=1)[self.place]  # of every subsequence

    def gram(self) -> np.ndarray:
        exact = self.values.astype(float)
        return exact.T @ exact

    def of_units(self, code: np.ndarray, start: np.ndarray, end: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
        """Units with a value of ``LEAST`` or more, and their rows of values
        (smaller ones 0). A bound on a unit's values skips the others: each
        subsequence counts with its largest landmark, over a norm without the
        (never negative) products of repeated subsequences."""
        found = [self._values(code, start[k:k + UNIT_BLOCK], end[k:k + UNIT_BLOCK], k)
                 for k in range(0, len(start), UNIT_BLOCK)]
        none = np.zeros(0, np.int64), np.zeros((0, len(self.landmarks)), np.float32)
        units, values = zip(none, *found, strict=True)
        return np.concatenate(units), np.concatenate(values)

    def _values(self, code: np.ndarray, start: np.ndarray, end: np.ndarray, base: int
                ) -> tuple[np.ndarray, np.ndarray]:
        size = end - start
        long_enough = np.flatnonzero(size >= ORDER)
        near, size = long_enough, size[long_enough]
        least = LEAST * np.sqrt(_least_squared_norm(size))
        if len(near):
            c, at = _spaced(code, start[near], size)
            top = np.zeros(len(c) - SPAN, np.float32)
            for pattern, w in zip(_OFFSETS, _WEIGHTS, strict=True):
                top += np.float32(w) * self.most[_keys(c, pattern)]
            bound = np.add.reduceat(top, at) >= 0.999 * least
            near, size, least = near[bound], size[bound], least[bound]
        if len(near):
            c, at = _spaced(code, start[near], size)
            place = self.place[np.stack([_keys(c, p) for p in _OFFSETS], axis=1)]
            where, pattern = np.nonzero(place)
            rows = self.values[place[where, pattern]] * _WEIGHTS[pattern, None].astype(np.float32)
            first = np.searchsorted(where, at)  # none is empty: its bound is above 0
            out = np.add.reduceat(rows, first, axis=0)
            hit = out.max(axis=1) >= 0.999 * least
            near, size, out = near[hit], size[hit], out[hit]
        if not len(near):
            return np.zeros(0, np.int64), np.zeros((0, len(self.landmarks)), np.float32)
        out = out / _norms(code, start[near], size)[:, None].astype(np.float32)
        out[out < LEAST] = 0
        hit = out.any(axis=1)
        return near[hit] + base, out[hit]


def _spaced(code: np.ndarray, start: np.ndarray, size: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """The units side by side, each followed by ``SPAN`` places without a
    symbol, and where each starts. No landmark's subsequence holds such a
    place."""
    at = np.cumsum(size + SPAN) - size - SPAN
    out = np.zeros(int((size + SPAN).sum()), np.int32)
    out[ranges(at, size)] = code[ranges(start, size)]
    return out, at


def _keys(spaced: np.ndarray, pattern: tuple[int, ...]) -> np.ndarray:
    """The subsequence at a pattern's places from every place on."""
    n = len(spaced) - SPAN
    key = spaced[:n]
    for d in pattern[1:]:
        key = key * _SYMBOLS + spaced[d:n + d]
    return key


def _least_squared_norm(size: np.ndarray) -> np.ndarray:
    """Squared norm of units of the given sizes if no subsequence repeats."""
    out = np.zeros(len(size))
    for pattern, w in zip(_OFFSETS, _WEIGHTS, strict=True):
        out += w * w * np.maximum(0, size - pattern[-1])
    return out


def _norms(code: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    parts = [(unit * _SYMBOLS ** ORDER + key, np.full(len(unit), w))
             for unit, key, w in occurrences(code, start, start + size)]
    full, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    value = np.bincount(inverse, weights=np.concatenate([w for _, w in parts]))
    return np.sqrt(np.bincount(full // _SYMBOLS ** ORDER, weights=value ** 2,
                               minlength=len(start)))


class SentenceFeatures:
    """Values of sentences against the landmarks, with a bounded memo of the
    units that this worker has met."""

    def __init__(self, landmarks: list[bytes]):
        self.kernel = LandmarkKernel(landmarks)
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[int, int] = {}
        self.filled = 0
        self.values = np.zeros((UNIT_BLOCK, len(self.kernel.landmarks)), np.float32)

    def _remember(self, values: np.ndarray) -> int:
        """Store rows of values; the first one's place."""
        at, self.filled = self.filled, self.filled + len(values)
        if self.filled > len(self.values):
            more = np.zeros((self.filled, self.values.shape[1]), np.float32)
            self.values = np.concatenate((self.values, more))
        self.values[at:self.filled] = values
        return at

    def of_slice(self, data: np.ndarray, offsets: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row and values of every sentence that resembles a landmark, and the
        number of sentences of each row."""
        u = cut_units(data, offsets)
        rows = len(offsets) - 1
        total = np.bincount(u.row, minlength=rows)
        if not len(u.start):
            return np.zeros(0, np.int64), self.values[:0], total
        uniq, first, inverse = np.unique(segment_hashes(u.code, u.start, u.end),
                                         return_index=True, return_inverse=True)
        if len(self.rows) + len(uniq) > MEMO_UNITS:
            self._forget()
        known = list(map(self.rows.get, uniq.tolist()))
        new = np.array([k for k, r in enumerate(known) if r is None], np.int64)
        if len(new):
            hit, values = self.kernel.of_units(u.code, u.start[first[new]], u.end[first[new]])
            found = np.full(len(new), -1)
            found[hit] = self._remember(values) + np.arange(len(hit))
            self.rows.update(zip(uniq[new].tolist(), found.tolist(), strict=True))
            for k, r in zip(new.tolist(), found.tolist(), strict=True):
                known[k] = r
        unit_row = np.array(known)[inverse]
        near = np.flatnonzero(unit_row >= 0)
        if not len(near):
            return np.zeros(0, np.int64), self.values[:0], total
        sentence = u.sentence[near]  # in order
        at = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1]))
        best = np.maximum.reduceat(self.values[unit_row[near]], at, axis=0)
        return u.row[sentence[at]], best, total


def train_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = COST,
              steps: int = 60) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine with squared hinge
    loss, by Newton steps on the active sentences."""
    z = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-3
    active = np.ones(len(z), bool)
    for _ in range(steps):
        a, c = z[active], cost * weight[active]
        w = np.linalg.solve(ridge + a.T @ (a * c[:, None]), a.T @ (c * y[active]))
        now = y * (z @ w) < 1
        if (now == active).all() or not now.any():
            break
        active = now
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a ridge logistic regression, intercept last."""
    z = np.column_stack((x, np.ones(len(x))))
    w, ridge = np.zeros(z.shape[1]), np.eye(z.shape[1]) * 1e-2
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = ridge + z.T @ (z * (p * (1 - p))[:, None])
        step = np.linalg.solve(h, z.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass
class Model:
    """A trained classifier; ``alpha`` are the machine's weights carried back
    through the Nyström map to the landmarks."""
    landmarks: list[bytes]
    alpha: np.ndarray
    bias: float
    calibration: np.ndarray

    def document_features(self, row: np.ndarray, values: np.ndarray, total: np.ndarray
                          ) -> np.ndarray:
        """Per document: its highest sentence score, what of it lies beyond
        half the margin, and how many of its sentences are toxic, as such and
        as a share."""
        n = len(total)
        score = values @ self.alpha + self.bias
        best = np.full(n, self.bias)
        np.maximum.at(best, row, score)
        toxic = np.bincount(row, weights=score > 0, minlength=n)
        return np.column_stack((np.clip(best, -3, 3), np.clip(best - 0.5, 0, 1), np.log1p(toxic),
                                toxic / np.maximum(total, 1)))

    def scores(self, row: np.ndarray, values: np.ndarray, total: np.ndarray) -> np.ndarray:
        x = self.document_features(row, values, total)
        z = x @ self.calibration[:-1] + self.calibration[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(landmarks: list[bytes], label: np.ndarray, doc: np.ndarray, values: np.ndarray,
        total: np.ndarray) -> Model:
    """Train on labelled sentences: ``doc`` and ``values`` of every sentence
    that resembles a landmark, ``label`` and number of sentences (``total``) of
    every document."""
    gram = LandmarkKernel(landmarks).gram()
    size, vectors = np.linalg.eigh(gram)
    keep = size > 1e-6 * size.max()
    nystrom = vectors[:, keep] / np.sqrt(size[keep])
    x, y = values @ nystrom, np.where(label[doc] > 0, 1.0, -1.0)
    # One sentence without any resemblance stands for all of those.
    x, y_all = np.vstack((x, np.zeros((1, x.shape[1])))), np.append(y, -1.0)
    used = np.ones(len(y_all), bool)
    for _ in range(WITNESS_ROUNDS):
        pos, neg = max(1, (used & (y_all > 0)).sum()), max(1, (y_all < 0).sum())
        weight = np.where(y_all > 0, 1 / pos, 1 / neg) * used.sum() / 2
        w, bias = train_svm(x[used], y_all[used], weight[used])
        score = x @ w + bias
        used = (y_all < 0) | (score > 0)
        toxic = np.flatnonzero(y > 0)
        order = toxic[np.lexsort((-score[toxic], doc[toxic]))]
        if len(order):
            used[order[np.append(True, np.diff(doc[order]) > 0)]] = True
    model = Model(landmarks, nystrom @ w, bias, np.zeros(5))
    model.calibration = _logistic(model.document_features(doc, values, total),
                                  (label > 0).astype(float))
    return model


def training_sample(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None,
                    documents: int = TRAIN_DOCS) -> DataFrame:
    """``text`` and ``toxic`` (0 or 1) of about ``documents`` labelled documents
    of either label, chosen by a hash of doc_id."""
    if may_learn is None:
        may_learn = ~is_held_out(F.col("doc_id"))
    known = (labels.where(F.col("toxic").isin(0, 1) & may_learn)
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max("toxic").cast("int").alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n"))
              .collect()}
    share = F.coalesce(*[F.when(F.col("toxic") == t, F.lit(min(1.0, documents / n)))
                         for t, n in sorted(counts.items())], F.lit(0.0))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < share * 1_000_003)
    # The sample's ids and labels are bounded, so they go to the texts.
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
            .join(F.broadcast(chosen), "doc_id").where(F.col("text").isNotNull())
            .select("text", "toxic"))


def _unit_rows(batches):
    """Units of each document, once each, with the document's label."""
    for batch in batches:
        label = np.asarray(batch.column("toxic"))
        for i, j, data, offsets in text_slices(batch.column("text"), SCORE_SLICE):
            u = cut_units(data, offsets)
            if not len(u.start):
                continue
            keep = u.end - u.start >= ORDER  # shorter ones have no subsequence
            start, end, row = u.start[keep], u.end[keep], u.row[u.sentence[keep]]
            h = segment_hashes(u.code, start, end)
            order = np.lexsort((h, row))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(row[order]) != 0) | (h[order][1:] != h[order][:-1])
            pick = order[new]
            raw = u.code.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([raw[a:b] for a, b in zip(start[pick].tolist(), end[pick].tolist(),
                                                    strict=True)], pa.binary()),
                 pa.array(label[i:j][row[pick]].astype(np.int32))], ["unit", "toxic"])


def choose_landmarks(sample: DataFrame, number: int = LANDMARKS, min_docs: int = MIN_DOCS
                     ) -> list[bytes]:
    """The units most associated with the toxic label, by the lower bound of
    their log-odds over documents. At most ``number`` rows reach the driver."""
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n"))
            .collect()}
    if len(size) < 2:
        return []
    seen = (sample.mapInArrow(_unit_rows, "unit binary, toxic int").groupBy("unit")
            .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
            .where(F.col("bad") >= min_docs))
    bad, good = F.col("bad") + 0.5, F.col("good") + 0.5
    odds = F.log(bad / (size[1] + 1 - bad)) - F.log(good / (size[0] + 1 - good))
    low = odds - 1.5 * F.sqrt(1 / bad + 1 / good)
    top = seen.select("unit", low.alias("low")).where("low > 0")
    return [bytes(r["unit"]) for r in
            top.orderBy(F.desc("low"), "unit").limit(number).collect()]


def train(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None,
          documents: int = TRAIN_DOCS, landmarks: int = LANDMARKS) -> Model | None:
    """Train on a bounded sample; the driver holds the landmarks and the
    landmark values of the sample's sentences. ``None`` if one label lacks."""
    sample = staged(training_sample(docs, labels, may_learn, documents), "toxicity-sample")
    chosen = choose_landmarks(sample, landmarks)
    if not chosen:
        return None

    def run(batches):
        features = SentenceFeatures(chosen)
        for batch in batches:
            label = batch.column("toxic")
            for i, j, data, offsets in text_slices(batch.column("text"), SCORE_SLICE):
                row, values, total = features.of_slice(data, offsets)
                # A document's nearest sentences, in order of the text.
                order = np.lexsort((-values.max(axis=1, initial=0), row))
                nth = np.arange(len(row)) - np.searchsorted(row, row)
                values = values[np.sort(order[nth < TRAIN_SENTENCES])]
                count = np.minimum(np.bincount(row, minlength=j - i), TRAIN_SENTENCES)
                at = np.concatenate(([0], np.cumsum(count)))
                packed = [values[a:b].astype(np.float32).tobytes()
                          for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [label.slice(i, j - i), pa.array(total.astype(np.int64)),
                     pa.array(packed, pa.binary())], ["toxic", "total", "packed"])
    rows = sample.mapInArrow(run, "toxic int, total long, packed binary").collect()
    # In an order that no task decides.
    rows.sort(key=lambda r: (r["toxic"], r["total"], bytes(r["packed"])))
    values = [np.frombuffer(r["packed"], np.float32).reshape(-1, len(chosen)) for r in rows]
    doc = np.repeat(np.arange(len(rows)), [len(v) for v in values])
    return fit(chosen, np.array([r["toxic"] for r in rows]), doc,
               np.concatenate(values).astype(float), np.array([r["total"] for r in rows]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` of every
    document."""
    def run(batches):
        features = SentenceFeatures(model.landmarks) if model else None
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column("text"), SCORE_SLICE):
                p = model.scores(*features.of_slice(data, offsets)) if model else np.zeros(j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i),
                     batch.column("held_out").slice(i, j - i), pa.array(p),
                     pa.array((p >= 0.5).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        is_held_out(F.col("doc_id")).alias("held_out"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))
