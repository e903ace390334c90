"""Lexical retrieval packing into fixed token windows.

Every document is encoded once (ids, then the separator id). Its full windows
hold nothing else; what is left, its tail, is packed with the tails of lexically
similar documents: retrieval compares the words of whole documents, counted in
the encoding pass. Tails are dealt out by the two smallest hashes of their
documents' words, one under either of two hash functions, so copies and texts
that share words tend to meet, in ranges that also cut on doc_id: a word or text
that a third of all rows share is spread over many tasks. A task reads its range
in blocks of ``SHARD_DOCS`` tails, or fewer if their documents hold
``SHARD_TERMS`` different words; each block is one shard with a BM25 inverted
index. A seed's window is filled greedily with its best unused neighbours; the
last one is cut at the window's end and its rest seeds the next window. Only the
last window of a task's range can stay short.

Words are compared by 32-bit hashes; a count above 65,535 is taken as that.

Cases: null text is empty and gives the separator alone; a document without a
word, or without one that another document of its shard holds, takes unused
tails in order; equal scores go to the earlier tail (by the hashes, then
doc_id); a very long text is encoded and counted as a whole, in memory
proportional to it; repeated rows are packed each, and pieces of rows that share
a doc_id, or have none, cannot be told apart; an empty table gives no pieces;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.llm.bpe import DEFAULT_TOKENIZER, encode_column, encoder
from covtab.llm.scratch import bound_batches, staged
from covtab.llm.textcore import mix64, ranges, segment_hashes

WINDOW = 1024
SEPARATOR = 0
SHARD_DOCS = 1024  # tails in one inverted index
SHARD_TERMS = 1 << 20  # different words of their documents, summed
K1, B = 1.2, 0.75

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


@lru_cache(maxsize=2)
def _leads(tokenizer: str) -> np.ndarray:
    """Whether a token starts a word: white space is its first byte."""
    known = encoder(tokenizer).token_bytes
    out = np.zeros(max(known) + 1, bool)
    for i, b in known.items():
        out[i] = b[:1].isspace()
    return out


def _words(ids: np.ndarray, offsets: np.ndarray, tokenizer: str
           ) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in the rows of ``ids``, and each word's row."""
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = _leads(tokenizer)[ids]
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[starts] = True
    at = np.flatnonzero(first)
    return (segment_hashes(ids, at, np.append(at[1:], len(ids))),
            np.searchsorted(offsets, at, side="right") - 1)


def _counted(words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different words of every row, by row and hash: row, hash and count."""
    pair = row.astype(np.uint64) << np.uint64(32) | words >> np.uint64(32)
    pair, count = np.unique(pair, return_counts=True)
    return ((pair >> np.uint64(32)).astype(np.int64), pair.astype(np.uint32),
            np.minimum(count, 0xFFFF))


def tails(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, window: int = WINDOW,
          separator: int = SEPARATOR) -> DataFrame:
    """Per document: ``doc_id``, ``doc_tokens`` (with the separator),
    ``full_crc32`` (of each full window), ``tail`` (the remaining ids as
    unsigned integers of the narrowest fitting width), ``terms`` and ``counts``
    (the whole document's different words, as ascending 32-bit hashes, and how
    often it holds them, 16 bits each), ``shard_key`` and ``near_key`` (smallest
    hashes under two functions)."""
    top = max(max(encoder(tokenizer).token_bytes), separator)
    kind = "<u2" if top < 1 << 16 else "<u4"

    def packed(values: np.ndarray, kind: str, cut: np.ndarray) -> pa.Array:
        raw, at = values.astype(kind).tobytes(), (cut * int(kind[2])).tolist()
        return pa.array([raw[x:y] for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for i, j, count, flat in encode_column(batch.column("text"), enc):
                total = count + 1
                upto = np.concatenate(([0], np.cumsum(total)))
                ids = np.full(upto[-1], separator, np.int64)
                own = np.ones(upto[-1], bool)
                own[upto[1:] - 1] = False
                ids[own] = flat
                full = [[_crc(ids[a + k * window:a + (k + 1) * window])
                         for k in range(n // window)]
                        for a, n in zip(upto[:-1].tolist(), total.tolist(), strict=True)]
                size = total % window
                rest = ids[ranges(upto[1:] - size, size)]
                row, term, often = _counted(*_words(
                    ids[own], np.concatenate(([0], np.cumsum(count))), tokenizer))
                first = np.searchsorted(row, np.arange(j - i + 1))
                has = np.flatnonzero(first[:-1] < first[1:])
                key, near = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
                if len(has):
                    key[has] = term[first[has]]
                    other = mix64(term.astype(np.uint64) + np.uint64(1)) >> np.uint64(1)
                    near[has] = np.minimum.reduceat(other, first[has]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(total),
                     pa.array(full, pa.list_(pa.int64())),
                     packed(rest, kind, np.concatenate(([0], np.cumsum(size)))),
                     packed(term, "<u4", first), packed(often, "<u2", first),
                     pa.array(key), pa.array(near)],
                    ["doc_id", "doc_tokens", "full_crc32", "tail", "terms", "counts",
                     "shard_key", "near_key"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, doc_tokens long, full_crc32 array<long>, "
                             "tail binary, terms binary, counts binary, "
                             "shard_key long, near_key long"))


class Shard:
    """BM25 inverted index of a block of documents: ``n`` of them, with the
    different words of each, in order of the documents, and their counts."""

    def __init__(self, row: np.ndarray, words: np.ndarray, tf: np.ndarray, n: int):
        self.n = n
        self.terms, term = np.unique(words, return_inverse=True)
        length = np.bincount(row, weights=tf, minlength=n)
        df = np.bincount(term, minlength=len(self.terms))
        order = np.argsort(term, kind="stable")
        self.docs = row[order]
        # A word in more than half of the shard's documents weighs nothing.
        idf = np.maximum(0, np.log((n - df + 0.5) / (df + 0.5)))
        mean = max(1.0, length.mean()) if n else 1.0
        norm = K1 * (1 - B + B * length[self.docs] / mean)
        self.weight = idf[term[order]] * tf[order] * (K1 + 1) / (tf[order] + norm)
        self.first = np.concatenate(([0], np.cumsum(df)))
        # A word of one document retrieves only that document.
        self.useful = (df > 1) & (idf > 0)
        self._doc_terms = term
        self._doc_first = np.searchsorted(row, np.arange(n + 1))

    def terms_of(self, doc: int) -> np.ndarray:
        return self._doc_terms[self._doc_first[doc]:self._doc_first[doc + 1]]

    def hashes_of(self, doc: int) -> np.ndarray:
        return self.terms[self.terms_of(doc)]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Terms of this shard among another shard's words."""
        at = np.searchsorted(self.terms, hashes)
        at = at[at < len(self.terms)]
        return at[np.isin(self.terms[at], hashes)]

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """BM25 score of every document for a query of ``terms``."""
        terms = terms[self.useful[terms]]
        at = ranges(self.first[terms], self.first[terms + 1] - self.first[terms])
        return np.bincount(self.docs[at], weights=self.weight[at], minlength=self.n)


class _Packer:
    """Fills windows one after the other; a window left open goes on in the
    next shard with its seed's words as the query."""

    def __init__(self, window: int, base: int):
        self.window = window
        self.sequence, self.wholes, self.room = base, base + (1 << 31), window
        self.query = np.zeros(0, np.uint32)
        self.out: list[tuple] = []

    def add(self, doc, start, length, crc, total):
        self.out.append((doc, start, length, crc, total, self.sequence, self.window - self.room))
        self.room -= length
        if self.room == 0:
            self.sequence, self.room = self.sequence + 1, self.window

    def whole(self) -> int:
        """The number of a window that one document fills."""
        self.wholes += 1
        return self.wholes - 1

    def shard(self, doc_id: list[int], total: list[int], parts: list[np.ndarray],
              words: list[np.ndarray], counts: list[np.ndarray]) -> None:
        sizes = [len(p) for p in parts]
        none = np.zeros(0, np.int64)
        index = Shard(np.repeat(np.arange(len(parts)), [len(w) for w in words]),
                      np.concatenate([none.astype(np.uint32), *words]),
                      np.concatenate([none, *counts]), len(parts))
        unused, left, next_, rest = np.array(sizes) > 0, int(np.count_nonzero(sizes)), 0, None

        def place(k: int, done: int) -> int | None:
            """Place tail ``k`` from ``done`` on; where it was cut, if it was."""
            n = min(self.room, sizes[k] - done)
            begin = total[k] - sizes[k] + done
            self.add(doc_id[k], begin, n, _crc(parts[k][done:done + n]), total[k])
            return done + n if done + n < sizes[k] else None

        while left or rest:
            if self.room == self.window:  # a new window: the cut tail's rest, or the next tail
                if rest:
                    k, done = rest
                else:
                    while not unused[next_]:
                        next_ += 1
                    k, done = next_, 0
                    unused[k], left = False, left - 1
                terms, self.query = index.terms_of(k), index.hashes_of(k)
                done = place(k, done)
                rest = (k, done) if done is not None else None
            else:  # opened by an earlier shard
                terms = index.find(self.query)
            if self.room == self.window or not left:
                continue
            score = index.scores(terms)
            score[~unused] = -1
            for k in np.argsort(-score, kind="stable").tolist():
                if score[k] < 0 or self.room == self.window:
                    break
                unused[k], left = False, left - 1
                done = place(k, 0)
                if done is not None:
                    rest = (k, done)
                    break
                if not left:
                    break


def pack(tail_rows: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, window: int = WINDOW,
         shard_terms: int = SHARD_TERMS) -> DataFrame:
    """Pieces of all documents: ``PIECES``. A task's sequences are numbered
    from its partition's number * 2**32, windows that one document fills from
    2**31 after that."""
    wide = max(encoder(tokenizer).token_bytes) >= 1 << 16
    stored = ["doc_id", "doc_tokens", "full_crc32", "tail", "terms", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(window, TaskContext.get().partitionId() << 32)
        names = [x.split()[0] for x in PIECES.split(", ")]

        def flush():
            cols = list(zip(*packer.out, strict=True))
            packer.out = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

        held, n_terms = ([], [], [], [], []), 0
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in stored]
            for doc, total, full, tail, terms, counts in zip(*cols, strict=True):
                for k, crc in enumerate(full):
                    packer.out.append((doc, k * window, window, crc, total, packer.whole(), 0))
                if tail:
                    for x, y in zip(held, (
                            doc, total, np.frombuffer(tail, "<u4" if wide else "<u2"),
                            np.frombuffer(terms, "<u4"), np.frombuffer(counts, "<u2")),
                            strict=True):
                        x.append(y)
                    n_terms += len(held[3][-1])
                if len(held[0]) == SHARD_DOCS or n_terms >= shard_terms:
                    packer.shard(*held)
                    held, n_terms = ([], [], [], [], []), 0
                    yield flush()
        packer.shard(*held)
        if packer.out:
            yield flush()
    return tail_rows.select(*stored).mapInArrow(run, PIECES)


def pack_documents(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER, window: int = WINDOW,
                   separator: int = SEPARATOR) -> DataFrame:
    """Pack whole documents into windows of ``window`` tokens. The encoded
    tails are written once to the shared scratch folder: choosing the ranges
    then reads only their keys, and a lost task re-reads instead of encoding."""
    bound_batches(docs.sparkSession)
    stored = staged(tails(docs, tokenizer, window, separator), "tails")
    dealt = stored.repartitionByRange("shard_key", "near_key", "doc_id")
    return pack(dealt.sortWithinPartitions("shard_key", "near_key", "doc_id", "tail"),
                tokenizer, window)
