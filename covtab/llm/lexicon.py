"""BPE encoding and decoding through a minimal acyclic transducer.

Frequent pre-tokeniser pieces are counted over every document, the
``lexicon_size`` most frequent are compiled into an automaton that shares
prefixes and suffixes, and each edge carries how many pieces it skips. The sum
along an accepted path numbers the piece, and that number finds its ids. The
compiled arrays are one file, which Spark hands to every executor
(``SparkContext.addFile``) and tasks memory-map. A piece the automaton does
not accept is merged by the tokenizer's own merges, so the lexicon changes
only speed, never ids.

Cases: null text is empty and gives no ids; the string of an added token gives
that token's id; repeated documents are encoded each; an empty table gives no
rows and an empty lexicon; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.llm.bpe import DEFAULT_TOKENIZER, Encoder, encode_column, encoder, pieces
from covtab.llm.scratch import staged
from covtab.llm.textcore import ranges, segment_hashes, text_slices

LEXICON_SIZE = 32_768  # pieces in the automaton; bounds what the driver holds
COUNT_FLUSH = 400_000  # distinct pieces a counting task holds at once


def _count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the distinct pieces of a task."""
    keys, counts, text = np.zeros(0, np.uint64), np.zeros(0, np.int64), {}

    def out():
        order = keys.tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array([text[k] for k in order], pa.binary()), pa.array(counts)], ["piece", "n"])

    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column("text")):
            start = pieces(data, offsets)
            if not len(start):
                continue
            end = np.append(start[1:], len(data))
            uniq, first, n = np.unique(segment_hashes(data, start, end), return_index=True,
                                       return_counts=True)
            at = np.searchsorted(keys, uniq)
            old = at < len(keys)
            old[old] = keys[at[old]] == uniq[old]
            counts[at[old]] += n[old]
            raw, new = data.tobytes(), ~old
            s, e = start[first[new]].tolist(), end[first[new]].tolist()
            text.update((k, raw[a:b]) for k, a, b in
                        zip(uniq[new].tolist(), s, e, strict=True))
            order = np.argsort(np.concatenate((keys, uniq[new])), kind="stable")
            keys = np.concatenate((keys, uniq[new]))[order]
            counts = np.concatenate((counts, n[new]))[order]
            if len(keys) > COUNT_FLUSH:
                yield out()
                keys, counts, text = keys[:0], counts[:0], {}
    if len(keys):
        yield out()


def piece_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of every pre-tokeniser piece over all documents:
    ``piece`` (binary), ``n``."""
    return (docs.select(F.col("text").cast("string").alias("text"))
            .mapInArrow(_count_pieces, "piece binary, n long")
            .groupBy("piece").agg(F.sum("n").alias("n")))


def frequent_pieces(docs: DataFrame, size: int = LEXICON_SIZE) -> list[bytes]:
    """The ``size`` most frequent pieces, ties to the smaller bytes. Counts are
    binned by powers of two first; only pieces of the bins that hold the first
    ``size`` are ordered, so tasks do not each send ``size`` rows to the driver."""
    counts = staged(piece_counts(docs), "piece-counts")
    power = F.floor(F.log2("n")).cast("int")
    bins = sorted(((r["power"], r["pieces"]) for r in counts.groupBy(power.alias("power"))
                   .agg(F.count("*").alias("pieces")).collect()), reverse=True)
    least, seen = 0, 0
    for bin_, held in bins:  # at most 63
        least, seen = 2 ** bin_, seen + held
        if seen >= size:
            break
    top = counts.where(F.col("n") >= least).orderBy(F.desc("n"), F.asc("piece")).limit(size)
    return [bytes(r["piece"]) for r in top.select("piece").collect()]


class _Node:
    __slots__ = ("edges", "final", "number", "words")

    def __init__(self):
        self.edges: dict[int, _Node] = {}
        self.final = False
        self.number = -1
        self.words = 0


def compile_lexicon(words: list[bytes], merge) -> np.ndarray:
    """The minimal automaton of ``words`` and their ids, as one array:
    counts, edge keys (state * 256 + byte), edge targets, edge skips, final
    flags, id offsets, ids. State 0 is the start."""
    words = sorted(set(words))
    root, known = _Node(), {}
    path: list[tuple[_Node, int, _Node]] = []  # the not yet shared tail of the last word

    def share(down_to: int) -> None:
        while len(path) > down_to:
            parent, byte, node = path.pop()
            shape = (node.final, tuple((b, id(n)) for b, n in node.edges.items()))
            parent.edges[byte] = known.setdefault(shape, node)

    last = b""
    for w in words:
        same = len(os.path.commonprefix((last, w)))
        share(same)
        node = path[-1][2] if path else root
        for byte in w[same:]:
            child = _Node()
            node.edges[byte] = child
            path.append((node, byte, child))
            node = child
        node.final = True
        last = w
    share(0)

    order: list[_Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node.number < 0:
            node.number = len(order)
            order.append(node)
            stack.extend(node.edges.values())

    def size(top: _Node) -> None:
        todo = [top]
        while todo:
            node = todo[-1]
            open_ = [n for n in node.edges.values() if not n.words]
            if open_:
                todo.extend(open_)
            else:
                node.words = node.final + sum(n.words for n in node.edges.values())
                todo.pop()

    if words:
        size(root)
    key, target, skip = [], [], []
    for node in order:
        before = int(node.final)
        for byte, child in sorted(node.edges.items()):
            key.append(node.number * 256 + byte)
            target.append(child.number)
            skip.append(before)
            before += child.words
    ids = [merge(w) for w in words]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64)
    flat = [i for x in ids for i in x]
    return np.concatenate([np.array(x, np.int64) for x in (
        [len(order), len(key), len(words), len(flat)], key, target, skip,
        [n.final for n in order], offsets, flat)])


class LexiconEncoder(Encoder):
    """An encoder that asks a memory-mapped automaton before it merges."""

    def __init__(self, path: str, tokenizer: str = DEFAULT_TOKENIZER):
        a = np.load(path, mmap_mode="r")
        states, edges, words, n_ids = (int(x) for x in a[:4])
        cuts = np.cumsum([4, edges, edges, edges, states, words + 1, n_ids])
        self._key, self._target, self._skip, final, self._offsets, self._known = (
            a[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True))
        self._final = np.array(final, bool)
        super().__init__(tokenizer)

    def _forget(self) -> None:
        super()._forget()
        self._ids = np.concatenate((np.asarray(self._known, np.uint32), self._ids))
        self._start[0] = len(self._known)

    def number(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each piece in the lexicon, -1 if it is not accepted: all
        pieces walk the automaton together, one byte a round."""
        out = np.full(len(start), -1, np.int64)
        if not len(self._key):
            return out
        live, state, total, step = np.arange(len(start)), np.zeros(len(start), np.int64), \
            np.zeros(len(start), np.int64), 0
        while len(live):
            at_end = start[live] + step == end[live]
            if at_end.any():
                done = at_end & self._final[state]
                out[live[done]] = total[done]
                live, state, total = live[~at_end], state[~at_end], total[~at_end]
            want = state * 256 + data[start[live] + step]
            edge = np.searchsorted(self._key, want)
            edge[edge == len(self._key)] = 0
            ok = self._key[edge] == want
            edge = edge[ok]
            live, state, total = live[ok], self._target[edge], total[ok] + self._skip[edge]
            step += 1
        return out

    def distinct(self, data, start, end):
        uniq, first, inverse = np.unique(segment_hashes(data, start, end),
                                         return_index=True, return_inverse=True)
        s, e = start[first], end[first]
        number = self.number(data, s, e)
        at, size = np.zeros(len(uniq), np.int64), np.zeros(len(uniq), np.int64)
        seen = number >= 0
        at[seen] = self._offsets[number[seen]]
        size[seen] = self._offsets[number[seen] + 1] - at[seen]
        new = ~seen
        rows = self.memo_rows(uniq[new].tolist(), data.tobytes(), s[new].tolist(),
                              e[new].tolist())
        at[new] = self._start[rows]
        size[new] = self._start[rows + 1] - self._start[rows]
        return at[inverse], size[inverse]


class Decoder:
    """Bytes of ids."""

    def __init__(self, enc: Encoder):
        top = max(enc.token_bytes) + 1
        parts = [enc.token_bytes.get(i, b"") for i in range(top)]
        self._offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        self._data = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids, and where each id's bytes begin (and end)."""
        ids = ids.astype(np.int64)
        at, size = self._offsets[ids], self._offsets[ids + 1] - self._offsets[ids]
        return self._data[ranges(at, size)].tobytes(), np.concatenate(([0], np.cumsum(size)))


_OPEN: dict[tuple[str, str], tuple[LexiconEncoder, Decoder]] = {}


def _codec(name: str, tokenizer: str) -> tuple[LexiconEncoder, Decoder]:
    if (name, tokenizer) not in _OPEN:
        _OPEN.clear()
        enc = LexiconEncoder(SparkFiles.get(name), tokenizer)
        _OPEN[name, tokenizer] = enc, Decoder(enc)
    return _OPEN[name, tokenizer]


def build_lexicon(docs: DataFrame, size: int = LEXICON_SIZE,
                  tokenizer: str = DEFAULT_TOKENIZER) -> str:
    """Compile the lexicon of ``docs`` and hand its file to the executors;
    returns the file's name for ``SparkFiles.get``."""
    packed = compile_lexicon(frequent_pieces(docs, size), encoder(tokenizer).merge)
    name = f"lexicon-{uuid.uuid4().hex}.npy"
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    np.save(path, packed)
    docs.sparkSession.sparkContext.addFile(path)
    return name


def encode_documents(docs: DataFrame, lexicon: str, tokenizer: str = DEFAULT_TOKENIZER
                     ) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded`` (their text) of every
    document: the operator's full output."""
    def run(batches):
        for batch in batches:
            enc, dec = _codec(lexicon, tokenizer)
            for i, j, count, ids in encode_column(batch.column("text"), enc):
                raw, at = dec.decode(ids)
                upto = np.concatenate(([0], np.cumsum(count)))
                lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()),
                                                 pa.array(ids.astype(np.int32)))
                cut = at[upto].tolist()
                texts = [raw[a:b].decode("utf-8", "replace")
                         for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), lists, pa.array(texts, pa.string())],
                    ["doc_id", "ids", "decoded"])
    return _input(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, lexicon: str, tokenizer: str = DEFAULT_TOKENIZER
                   ) -> DataFrame:
    """Per document: ``doc_id``, ``n_tokens``, ``ids_sha256`` (ids as
    little-endian unsigned 32-bit integers) and ``decoded_sha256`` (UTF-8 of
    the decoded text)."""
    def run(batches):
        for batch in batches:
            enc, dec = _codec(lexicon, tokenizer)
            for i, j, count, ids in encode_column(batch.column("text"), enc):
                raw, at = dec.decode(ids)
                upto = np.concatenate(([0], np.cumsum(count)))
                packed, cut = ids.astype("<u4").tobytes(), at[upto].tolist()
                four = (upto * 4).tolist()
                ids_sha = [hashlib.sha256(packed[a:b]).hexdigest()
                           for a, b in zip(four[:-1], four[1:], strict=True)]
                text_sha = [hashlib.sha256(raw[a:b].decode("utf-8", "replace").encode())
                            .hexdigest() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(count), pa.array(ids_sha),
                     pa.array(text_sha)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _input(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
