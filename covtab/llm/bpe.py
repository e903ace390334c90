"""Exact byte-level BPE over Arrow text columns.

The pre-tokeniser (contractions, then runs of letters, numbers, others with
one leading space, then white space) is evaluated with array operations over
the bytes of a slice; each distinct piece of a slice is then encoded once. A
bounded memo keeps the ids of pieces already merged by this worker.

A text that holds the string of an added token yields that token's id, as the
tokenizer file's own library does when special tokens are not escaped.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from covtab.llm.textcore import SLICE_BYTES, as_bytes, ranges, segment_hashes, slices

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
MEMO_PIECES = 200_000

_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
# The code points with the White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The contraction endings that form a piece with their apostrophe.
CONTRACTIONS = [b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"]


def tokenizer_path(name: str) -> str:
    """A public tokenizer file: a path as it is, or a name in the installed
    collection of public tokenizers."""
    if "/" in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point. Where two Unicode editions disagree on one,
    the tokenizer library's own pre-tokeniser decides: a letter stays with a
    letter before it, a number with a number."""
    from tokenizers.pre_tokenizers import ByteLevel

    known = np.zeros(0x110000, np.uint8)
    newer = np.zeros(0x110000, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, points))
    kind = {"L": _LETTER, "N": _NUMBER}
    known[points] = [kind.get(unicodedata.category(c)[0], _OTHER) for c in every]
    for pattern, cls in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER)):
        newer[[ord(c) for c in regex.findall(pattern, every)]] = cls
    unsure = np.flatnonzero(known != newer)
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    known[unsure] = _OTHER
    for before, cls in (("a", _LETTER), ("1", _NUMBER)):
        found = split("".join(f"{before}{chr(c)}\n" for c in unsure))
        whole = {span[0] // 3 for _, span in found if span[1] - span[0] == 2}
        known[unsure[sorted(whole)]] = cls
    known[WHITE_SPACE] = _SPACE
    return known


def _byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of each byte; all bytes of a character share its class."""
    table = _classes()
    cls = table[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        b = data[lead].astype(np.int64)
        for low, high, size, mask in ((0xC0, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F),
                                      (0xF0, 0x100, 4, 0x07)):
            at = lead[(b >= low) & (b < high)]
            if len(at):
                cp = data[at].astype(np.int64) & mask
                for k in range(1, size):
                    cp = (cp << 6) | (data[at + k] & 0x3F)
                c = table[cp]
                for k in range(size):
                    cls[at + k] = c
    return cls


def pieces(data: np.ndarray, seg: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokeniser's pieces. ``seg``: starts of the texts in
    ``data`` and its length at the end; no piece crosses a text."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    cls = _byte_classes(data)
    cut = np.empty(n + 1, bool)
    cut[0] = cut[n] = True
    np.not_equal(cls[1:], cls[:-1], out=cut[1:n])
    cut[seg] = True
    # White space before something else gives its last character away: a
    # space leads the next piece, any other one stands alone.
    space = cls == _SPACE
    run_end = np.flatnonzero(space & cut[1:]) + 1
    ends_text = np.zeros(n + 1, bool)
    ends_text[seg] = True
    run_end = run_end[~ends_text[run_end]]
    last = run_end - 1
    while len(back := np.flatnonzero((data[last] & 0xC0) == 0x80)):
        last[back] -= 1
    cut[last] = True
    cut[run_end[data[last] == 0x20]] = False
    # Contractions, where an apostrophe starts a piece.
    at = np.flatnonzero((data == 0x27) & cut[:n])
    if len(at):
        padded = np.concatenate((data, np.zeros(3, np.uint8)))
        bound = seg[np.searchsorted(seg, at, side="right")]
        for ending in CONTRACTIONS:
            hit = at + len(ending) < bound
            for k, c in enumerate(ending):
                hit &= padded[at + 1 + k] == c
            found = at[hit]
            cut[found + 1] = False
            cut[found + 1 + len(ending)] = True
    return np.flatnonzero(cut[:n])


class Encoder:
    """Ids of texts under one tokenizer file."""

    def __init__(self, tokenizer: str = DEFAULT_TOKENIZER):
        import tiktoken

        with open(tokenizer_path(tokenizer), encoding="utf-8") as f:
            spec = json.load(f)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(printable)]
        to_byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
        self.added = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in s): i for s, i in spec["model"]["vocab"].items()
                 if s.encode() not in self.added}
        self._bpe = tiktoken.Encoding("file", pat_str=r"\s+|\S+", mergeable_ranks=ranks,
                                      special_tokens={})
        self._merge = self._bpe._core_bpe.encode_single_piece
        self.token_bytes = {i: b for b, i in ranks.items()} | {i: b for b, i in self.added.items()}
        self._forget()

    def _forget(self) -> None:
        self._rows: dict[int, int] = {}
        self._start = np.zeros(MEMO_PIECES + 1, np.int64)
        self._ids = np.zeros(1 << 16, np.uint32)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-tokeniser piece, by the merges of the file."""
        return self._merge(piece)

    def memo_rows(self, hashes: list[int], raw: bytes, start: list[int],
                  end: list[int]) -> np.ndarray:
        """Memo row of each distinct piece ``raw[start:end]``, merging those
        not yet known."""
        if len(self._rows) + len(hashes) > MEMO_PIECES:
            self._forget()
            if len(hashes) > MEMO_PIECES:
                self._start = np.zeros(len(hashes) + 1, np.int64)
        rows = list(map(self._rows.get, hashes))
        new = [k for k, r in enumerate(rows) if r is None]
        if new:
            found = list(map(self._merge, [raw[start[k]:end[k]] for k in new]))
            n, m = len(self._rows), len(new)
            sizes = np.fromiter(map(len, found), np.int64, m)
            at = int(self._start[n])
            upto = at + np.cumsum(sizes)
            if upto[-1] > len(self._ids):
                more = max(len(self._ids), int(upto[-1]))
                self._ids = np.concatenate((self._ids, np.zeros(more, np.uint32)))
            self._ids[at:upto[-1]] = np.fromiter(chain.from_iterable(found), np.uint32,
                                                 int(sizes.sum()))
            self._start[n + 1:n + m + 1] = upto
            self._rows.update(zip([hashes[k] for k in new], range(n, n + m), strict=True))
            for i, k in enumerate(new):
                rows[k] = n + i
        return np.array(rows, np.int64)

    def distinct(self, data: np.ndarray, start: np.ndarray, end: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
        """First id and number of ids in ``ids_table()`` of every piece."""
        uniq, first, inverse = np.unique(segment_hashes(data, start, end),
                                         return_index=True, return_inverse=True)
        raw = data.tobytes()
        s, e = start[first].tolist(), end[first].tolist()
        rows = self.memo_rows(uniq.tolist(), raw, s, e)
        return self._start[rows][inverse], (self._start[rows + 1] - self._start[rows])[inverse]

    def ids_table(self) -> np.ndarray:
        return self._ids

    def _segments(self, data: np.ndarray, offsets: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text starts cut at added tokens, with the spans of those tokens'
        strings (starts and ids)."""
        raw, marks = None, []
        for content, token in self.added.items():
            raw = data.tobytes() if raw is None else raw
            at = raw.find(content)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(content) <= offsets[row + 1]:
                    marks.append((at, at + len(content), token))
                    at = raw.find(content, at + len(content))
                else:
                    at = raw.find(content, at + 1)
        if not marks:
            z = np.zeros(0, np.int64)
            return offsets, z, z
        marks.sort()
        lo, hi, token = (np.array(x, np.int64) for x in zip(*marks, strict=True))
        return np.unique(np.concatenate((offsets, lo, hi))), lo, token

    def encode(self, data: np.ndarray, offsets: np.ndarray, ids: bool = True
               ) -> tuple[np.ndarray, np.ndarray | None]:
        """Number of ids of each row, and all ids one after the other."""
        if len(data) == 0:
            return np.zeros(len(offsets) - 1, np.int64), np.zeros(0, np.uint32)
        seg, special, token = self._segments(data, offsets)
        start = pieces(data, seg)
        if len(special):
            # One piece for each added token's string.
            after = seg[np.searchsorted(seg, special, side="right")]
            owner = np.searchsorted(special, start, side="right") - 1
            inner = (owner >= 0) & (start > special[owner]) & (start < after[owner])
            start = start[~inner]
        end = np.append(start[1:], len(data))
        at, size = self.distinct(data, start, end)
        if len(special):
            where = np.searchsorted(start, special)
            size[where] = 1
        upto = np.concatenate(([0], np.cumsum(size)))
        first = np.searchsorted(start, offsets, side="left")
        count = upto[first[1:]] - upto[first[:-1]]
        if not ids:
            return count, None
        out = self.ids_table()[ranges(at, size)]
        if len(special):
            out[upto[where]] = token
        return count, out


_ENCODERS: dict[str, Encoder] = {}


def encoder(tokenizer: str = DEFAULT_TOKENIZER) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    if tokenizer not in _ENCODERS:
        _ENCODERS[tokenizer] = Encoder(tokenizer)
    return _ENCODERS[tokenizer]


def _safe_cuts(data: np.ndarray, limit: int) -> np.ndarray:
    """Places to part one long text without changing its pieces: a space
    between two ASCII letters, about every ``limit`` bytes."""
    low = data | 0x20
    letter = (low >= 97) & (low <= 122)
    ok = np.flatnonzero((data[1:-1] == 0x20) & letter[:-2] & letter[2:]) + 1
    if not len(ok):
        return np.array([0, len(data)])
    want = np.arange(limit, len(data), limit)
    k = np.searchsorted(ok, want)
    return np.unique(np.concatenate(([0], ok[k[k < len(ok)]], [len(data)])))


def encode_column(col: pa.Array, enc, ids: bool = True, limit: int = SLICE_BYTES
                  ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray | None]]:
    """``(first row, last row, ids per row, ids)`` for bounded slices of a
    column; one text longer than ``limit`` is encoded part by part."""
    data, offsets = as_bytes(col)
    for i, j in slices(offsets, limit):
        o = offsets[i:j + 1]
        part, o = data[o[0]:o[-1]], o - o[0]
        if len(part) <= limit or any(c in part.tobytes() for c in enc.added):
            yield i, j, *enc.encode(part, o, ids)
            continue
        total, out = 0, []
        cuts = _safe_cuts(part, limit)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            n, x = enc.encode(part[a:b], np.array([0, b - a]), ids)
            total += int(n[0])
            out.append(x)
        yield i, j, np.array([total]), np.concatenate(out) if ids else None
