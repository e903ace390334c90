"""Secret scans: fixed patterns, and two character Markov models.

Base spans come from three patterns (assignments, access keys, long hex runs).
The method adds spans of kind ``markov``: a run of key characters that the
model of random strings explains better than the model of ordinary
identifiers, by a log-likelihood ratio. Both are first-order character models
with add-one smoothing. Their training samples are labelled by the corpus
itself: the strings that the base patterns single out are random, runs that
none of them touches and that hold letters of one case are ordinary. The
sample is bounded: about ``TRAIN_DOCS`` documents, chosen by a hash of doc_id,
and of their strings the ``TRAIN_STRINGS`` of smallest hash of either label.

Only what lies outside the base spans is scored, so every part of a run that
one of them cuts is scored by itself. A run that is random as a whole is one
span. In any other, as in a path that ends in a key, its separator-bounded parts
are scored by the same rule, and so are its maximal stretches: those whose summed
ratio above the least mean no shorter or longer stretch beside them exceeds. Each
must have a summed ratio of ``MIN_EVIDENCE``, so a shorter one must be the more
random. A stretch takes in the separator-bounded parts of which it covers at
least half. Base spans always stay. Positions are code points, ends exclusive.

Cases: null text is empty and has no spans; a very long text, or one run that
fills it, takes time and memory in proportion; repeated rows and rows that share
or lack a doc_id are scanned each; of spans with one start the base kinds come
first; without training strings of either label the models are uniform and add
nothing; an empty table gives no rows; ``scan`` reads doc_id and text alone,
``redact`` keeps every column, whatever its name, and renews ``n_chars`` where
that is a number.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")
# The patterns and least lengths of the base kinds.
ASSIGN = (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
# Maximal runs: asking for the least length drops just the failing matches.
_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
MIN_RUN = 16
_RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
_PART = re.compile(r"[A-Za-z0-9]+")
_TRAIN_RUN = re.compile(r"[A-Za-z0-9+/_=-]{6,}")
_HAS_KEY = re.compile(r"[:=]")

TRAIN_DOCS = 20_000  # about; bounds the training texts
TRAIN_STRINGS = 4_000  # of either label; bounds what the driver holds
MIN_LLR_PER_CHAR = 0.25  # nats
MIN_EVIDENCE = 8.0  # nats; at 6 the given tables' "clown" is a key
_BLOCK = 1 << 16  # about; characters of a text looked at side by side
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.full(128, len(ALPHABET), np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base kinds, by start, then kind."""
    out = []
    if _HAS_KEY.search(text):
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text)
                if m.end() - m.start() >= MIN_ACCESS]
    out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _secret_part(text: str, span: tuple[int, int, str]) -> str:
    found = text[span[0]:span[1]]
    return _ASSIGN.match(found)[2] if span[2] == "assign" else found


def labelled_strings(text: str) -> Iterator[tuple[int, str]]:
    """``(label, string)``: 1 for what a base pattern singles out, 0 for an
    ordinary identifier."""
    spans = base_spans(text)
    for s in spans:
        yield 1, _secret_part(text, s)
    taken = _merged([(s, e) for s, e, _ in spans])
    k = 0
    for m in _TRAIN_RUN.finditer(text):
        word = m[0]
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if (word.isalpha() and (word[1:].islower() or word.isupper())
                and not (k < len(taken) and taken[k][0] < m.end())):
            yield 0, word


class Markov:
    """First-order character model: log probabilities of the next character
    given the one before, with a start state."""

    def __init__(self, strings: list[str]):
        n = len(ALPHABET)
        counts = np.ones((n + 1, n + 1))
        for s in strings:
            code = _codes(s)
            np.add.at(counts, (np.concatenate(([n], code[:-1])), code), 1)
        self.table = np.log(counts / counts.sum(axis=1, keepdims=True))


def _codes(s: str) -> np.ndarray:
    raw = np.frombuffer(s.encode("ascii", "replace"), np.uint8)
    return _CODE[np.minimum(raw, 127)]


def llr_table(random: list[str], ordinary: list[str]) -> np.ndarray:
    """Log-likelihood ratio of each transition, random against ordinary."""
    if not random or not ordinary:
        return np.zeros((len(ALPHABET) + 1,) * 2)
    return Markov(random).table - Markov(ordinary).table


def llr_per_char(s: str, table: np.ndarray) -> float:
    """Mean log-likelihood ratio of a string's transitions."""
    code = _codes(s)
    return float(table[np.concatenate(([len(ALPHABET)], code[:-1])), code].sum() / len(code))


def _maximal_stretches(score: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the maximal stretches of ``score``, in order: the stretch of
    largest sum, and the same again on either side of it, as long as a sum is
    positive. One pass over the blocks of positive scores, each of which joins
    or begins a stretch; links lead past those that cannot take it."""
    positive = score > 0
    first = np.concatenate(([0], np.flatnonzero(positive[1:] != positive[:-1]) + 1))
    last = np.concatenate((first[1:], [len(score)]))
    upto = np.concatenate(([0.0], np.cumsum(np.add.reduceat(score, first))))
    keep = np.flatnonzero(positive[first])
    found: list[tuple[int, int, float, float, int]] = []  # bounds, sums before and with, link
    for s, e, low, high in zip(first[keep].tolist(), last[keep].tolist(), upto[keep].tolist(),
                               upto[keep + 1].tolist(), strict=True):
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append((s, e, low, high, j))
                break
            s, _, low, _, _ = found[j]
            del found[j:]
    return [f[:2] for f in found]


def _random_alone(s: str, table: np.ndarray) -> bool:
    return (len(s) >= MIN_RUN and any(c.isalpha() for c in s)
            and llr_per_char(s, table) >= MIN_LLR_PER_CHAR)


def run_spans(run: str, table: np.ndarray) -> list[tuple[int, int]]:
    """The random-looking stretches of a run of key characters."""
    if _random_alone(run, table):
        return [(0, len(run))]
    parts = [m.span() for m in _PART.finditer(run)]
    out = [(p, q) for p, q in parts if _random_alone(run[p:q], table)]
    begins = [p for p, _ in parts]

    def part_around(at: int) -> tuple[int, int] | None:
        k = bisect.bisect_left(begins, at) - 1
        return parts[k] if k >= 0 and at < parts[k][1] else None
    code = _codes(run)
    ratio = table[np.concatenate(([len(ALPHABET)], code[:-1])), code]
    total = np.concatenate(([0.0], np.cumsum(ratio)))
    # Above the least mean, so that a stretch has that mean.
    for s, e in _maximal_stretches(ratio - MIN_LLR_PER_CHAR):
        if total[e] - total[s] < MIN_EVIDENCE:
            continue
        if around := part_around(s):
            p, q = around
            s = p if 2 * (min(e, q) - s) >= q - p else min(e, q)
        if around := part_around(e):
            p, q = around
            e = q if 2 * (e - max(s, p)) >= q - p else max(s, p)
        while s < e and not run[s].isalnum():
            s += 1
        # Trailing "=" fill up a key.
        while s < e and not run[e - 1].isalnum() and run[e - 1] != "=":
            e -= 1
        if any(c.isalpha() for c in run[s:e]):
            out.append((s, e))
    return _merged(out)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], e)
        else:
            out.append((s, e))
    return out


def _candidate_runs(text: str, table: np.ndarray, touched: list[tuple[int, int]]
                    ) -> Iterator[tuple[int, int]]:
    """Bounds of the runs that can hold a span: long ones, those whose positive
    ratios suffice, and those that a span of ``touched`` (in order, apart) cuts."""
    at, other = 0, len(ALPHABET)
    touched_end = np.array([e for _, e in touched], np.int64)
    touched_begin = np.array([*[s for s, _ in touched], np.iinfo(np.int64).max], np.int64)
    while at < len(text):
        end = min(len(text), at + _BLOCK)
        run = _RUN.match(text, end)
        end = run.end() if run else end
        code = _CODE[np.minimum(np.frombuffer(text[at:end].encode("utf-32-le"), np.uint32), 127)]
        before = np.concatenate(([other], code[:-1]))
        gain = np.where(code == other, 0, np.maximum(table[before, code], 0))
        total = np.concatenate(([0.0], np.cumsum(gain)))
        edge = np.diff(np.concatenate(([0], (code != other).astype(np.int8), [0])))
        start, stop = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
        # The sums are rounded.
        good = ((stop - start >= MIN_RUN)
                | (total[stop] - total[start] >= MIN_EVIDENCE - 1e-6))
        if touched:
            k = np.searchsorted(touched_end, start + at, side="right")
            good |= touched_begin[k] < stop + at
        yield from zip((start[good] + at).tolist(), (stop[good] + at).tolist(), strict=True)
        at = end


def markov_spans(text: str, base: list[tuple[int, int, str]], table: np.ndarray
                 ) -> list[tuple[int, int, str]]:
    """Stretches of key characters that look random; digits alone are no key."""
    out = []
    if not table.any():
        return out
    taken = _merged([(s, e) for s, e, _ in base])
    k = 0
    for start, end in _candidate_runs(text, table, taken):
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        at, free, j = start, [], k
        while j < len(taken) and taken[j][0] < end:
            free.append((at, taken[j][0]))
            at = taken[j][1]
            j += 1
        for a, b in [*free, (at, end)]:
            if a < b:
                out += [(a + s, a + e, "markov") for s, e in run_spans(text[a:b], table)]
    return out


def train(docs: DataFrame, documents: int = TRAIN_DOCS, strings: int = TRAIN_STRINGS
          ) -> np.ndarray:
    """The ratio table, from at most ``strings`` distinct strings of either
    label in about ``documents`` documents. A task sends on only as many of
    each, those of smallest hash."""
    def run(batches):
        best: dict[int, dict[str, int]] = {0: {}, 1: {}}

        def trim(label):
            top = sorted(best[label].items(), key=lambda x: (x[1], x[0]))[:strings]
            best[label] = dict(top)

        for batch in batches:
            for text in batch.column("text"):
                for label, s in labelled_strings(text.as_py() or ""):
                    if s not in best[label]:
                        best[label][s] = int.from_bytes(
                            hashlib.blake2b(s.encode(), digest_size=7).digest(), "big")
                        if len(best[label]) > 8 * strings:
                            trim(label)
        rows = []
        for label in best:
            trim(label)
            rows += [(label, s, h) for s, h in best[label].items()]
        if rows:
            label, s, h = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(label, pa.int32()), pa.array(s), pa.array(h, pa.int64())],
                ["label", "s", "h"])
    share = min(1.0, documents / max(1, docs.count()))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < share * 1_000_003)
    found = (chosen.select(F.col("text").cast("string").alias("text"))
             .mapInArrow(run, "label int, s string, h long").distinct())
    place = F.row_number().over(Window.partitionBy("label").orderBy("h", "s"))
    rows = (found.withColumn("place", place).where(F.col("place") <= strings)
            .select("label", "s").collect())
    parts = {label: sorted(r["s"] for r in rows if r["label"] == label) for label in (0, 1)}
    return llr_table(parts[1], parts[0])


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


def scan(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """Per document: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``,
    ``n_markov``, ``base_sha256`` (of the base spans) and ``spans`` (all
    spans), each span as kind:start:end, by start, then kind."""
    def run(batches):
        for batch in batches:
            counts, sha, spans = [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                more = markov_spans(text, base, table)
                every = sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
                counts.append([sum(s[2] == k for s in every) for k in KINDS])
                sha.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(every))
            by_kind = list(zip(*counts, strict=True)) or [()] * len(KINDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in by_kind],
                 pa.array(sha, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, "
                             "n_markov long, base_sha256 string, spans string"))


MASK = "[SECRET]"


def redact_text(text: str, table: np.ndarray) -> str:
    """``text`` with every found span replaced by ``MASK``; spans that overlap
    are one."""
    base = base_spans(text)
    out, at = [], 0
    for s, e, _ in sorted(base + markov_spans(text, base, table)):
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """The documents with their secrets masked, and ``n_chars`` of the new text
    where that column is a number; null texts stay null."""
    columns = docs.columns

    def run(batches):
        for batch in batches:
            texts = [None if t is None else redact_text(t, table)
                     for t in batch.column("text").to_pylist()]
            cols = {name: batch.column(name) for name in columns}
            cols["text"] = pa.array(texts, pa.string())
            if "n_chars" in cols and pa.types.is_integer(cols["n_chars"].type):
                changed = [n if t is None else len(t) for t, n in
                           zip(texts, cols["n_chars"].to_pylist(), strict=True)]
                cols["n_chars"] = pa.array(changed, cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))
    return docs.mapInArrow(run, docs.schema)
