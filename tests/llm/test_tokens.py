"""Encoding, decoding, length histogram and packing against the tokenizers
library and brute force."""
import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from covtab.llm import bpe, histogram, lexicon, packing
from tests.llm.conftest import EDGE_TEXTS

PATH = bpe.tokenizer_path(bpe.DEFAULT_TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def by_column(texts, enc, limit=1 << 20):
    out = []
    for i, j, count, ids in bpe.encode_column(pa.array(texts, pa.string()), enc, limit=limit):
        upto = np.concatenate(([0], np.cumsum(count)))
        out += [ids[upto[k]:upto[k + 1]].tolist() for k in range(j - i)]
    return out


def test_encoder_equals_library_on_random_strings(library):
    rng = random.Random(5)
    bits = ["a", "B", "é", "中", "1", "²", " ", "  ", "\n", "\t", " ",
            "　", "'", "'s", "'ll", "'re", "'LL", "!", "#", "<|endoftext|>", "\U0001f600",
            "́", "\x1c", "\U00013460", "<|"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    assert by_column(texts, bpe.encoder(), 5000) == [ids_of(library, t) for t in texts]


def test_long_text_is_cut_only_where_pieces_end(library):
    text = " ".join(["alpha's", "beta,", "12", "été", "gamma delta  x\n"] * 300)
    assert by_column([text, "b"], bpe.encoder(), 500) == [ids_of(library, t)
                                                          for t in (text, "b")]


def test_lexicon_is_minimal_and_numbers_every_word():
    words = [b"tap", b"taps", b"top", b"tops", b"stop", b"stops", b"\xc3\xa9", b"a"]
    packed = lexicon.compile_lexicon(words, lambda w: list(w))
    # Shared suffixes: "ap|op" meet in p, and all plurals in one last state.
    assert packed[0] < 1 + sum(map(len, words)) // 2
    assert packed[2] == len(words)


def test_lexicon_encoder_and_empty_lexicon(tmp_path, library):
    texts = ["tap taps top stop stops", "unseen taps", "x", None]
    for k, words in enumerate(([], [b" taps", b" top", b"tap", b" stop", b" stops"])):
        path = str(tmp_path / f"{k}.npy")
        np.save(path, lexicon.compile_lexicon(words, bpe.encoder().merge))
        enc = lexicon.LexiconEncoder(path)
        data = np.frombuffer(b"".join(words) + b"ta", np.uint8)
        end = np.cumsum([*map(len, words), 2])
        start = np.concatenate(([0], end[:-1]))
        assert sorted(enc.number(data, start, end)) == [-1, *range(len(words))]
        assert by_column(texts, enc) == [ids_of(library, t) for t in texts]


def test_encode_documents_round_trip(docs_of, small_docs, library):
    for docs in (docs_of(EDGE_TEXTS), docs_of([]), small_docs):
        name = lexicon.build_lexicon(docs, size=500)
        text = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
        full = {r.doc_id: r for r in lexicon.encode_documents(docs, name).collect()}
        assert full.keys() == text.keys()
        digests = {r.doc_id: r for r in lexicon.encode_digests(docs, name).collect()}
        for i, t in text.items():
            ids = ids_of(library, t)
            assert full[i].ids == ids
            assert full[i].decoded == library.decode(ids, skip_special_tokens=False) == t
            assert digests[i].n_tokens == len(ids)
            assert digests[i].ids_sha256 == hashlib.sha256(
                struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
            assert digests[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_piece_counts_cover_all_rows(docs_of, library):
    docs = docs_of(["a b a", "a b", None])
    got = {bytes(r.piece): r.n for r in lexicon.piece_counts(docs).collect()}
    assert got == {b"a": 2, b" b": 2, b" a": 1}


def test_histogram_answers_every_limit(docs_of, small_docs, library):
    for docs in (docs_of(EDGE_TEXTS), small_docs):
        lengths = [len(ids_of(library, r.text)) for r in docs.select("text").collect()]
        hist = histogram.length_histogram(docs)
        assert {r.length: r.docs for r in hist.collect()} == Counter(lengths)
        for r in histogram.suffix_sums(hist).collect():
            limit = r.length
            assert r.docs_at_least == sum(n >= limit for n in lengths)
            assert r.tokens_at_least == sum(n for n in lengths if n >= limit)
            assert r.docs_longer == sum(n > limit for n in lengths)
            assert r.truncated_tokens == sum(min(n, limit) for n in lengths)
            assert r.lost_tokens == sum(lengths) - r.truncated_tokens
            assert r["quantile"] == pytest.approx(
                sum(n <= limit for n in lengths) / len(lengths))
        limits = [0, 1, 7, 100, 10**6]
        for r in histogram.truncated_totals(hist, limits).collect():
            assert r.truncated_tokens == sum(min(n, r.limit) for n in lengths)
            assert r.docs_longer == sum(n > r.limit for n in lengths)
        ordered = sorted(lengths)
        for r in histogram.length_quantiles(histogram.suffix_sums(hist), [0.1, 0.5, 1]).collect():
            want = ordered[max(0, int(np.ceil(r.probability * len(ordered) - 1e-9)) - 1)]
            assert r.length == want


def test_histogram_of_no_documents(docs_of):
    hist = histogram.length_histogram(docs_of([]))
    assert histogram.suffix_sums(hist).count() == 0
    assert [tuple(r) for r in histogram.truncated_totals(hist, [8]).collect()] == [(8, 0, 0, 0)]
    assert histogram.length_quantiles(histogram.suffix_sums(hist), [0.5]).first().length is None


def check_pieces(rows, texts, library, window):
    """Every id in exactly one piece, sequences gapless and within the window."""
    of, seq = defaultdict(list), defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
        seq[r.sequence_id].append(r)
    for i, text in texts.items():
        ids, at = [*ids_of(library, text), 0], 0
        for r in sorted(of.pop(i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            part = ids[at:at + r.length]
            assert r.length == len(part) > 0
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(ids)
    assert not of
    for pieces in seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return seq


def test_packing_keeps_every_id_once(docs_of, small_docs, library):
    for docs, window in ((docs_of(EDGE_TEXTS), 8), (docs_of([]), 8), (small_docs, 128)):
        texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        rows = packing.pack_documents(docs, window=window).collect()
        seq = check_pieces(rows, texts, library, window)
        short = [s for s in seq.values() if sum(r.length for r in s) < window]
        assert len(short) <= 8  # the last window of a task's range only


def test_packing_puts_lexical_neighbours_together(docs_of, monkeypatch):
    topics = ["red apple pear plum", "steel copper iron zinc", "violin cello flute oboe"]
    docs = docs_of([f"{t} {n}" for n in range(8) for t in topics]).coalesce(1)
    rows = packing.pack(packing.tails(docs, window=32).coalesce(1), window=32).collect()
    seq = defaultdict(set)
    for r in rows:
        seq[r.sequence_id].add(r.doc_id % 3)
    assert np.mean([len(s) == 1 for s in seq.values()]) >= 0.6


def test_bm25_scores_equal_the_formula():
    parts = [[10, 11, 12], [10, 11, 12, 13], [20, 21], [22, 23, 24, 25]]
    ids = np.array([i for p in parts for i in p])
    offsets = np.array([0, 3, 7, 9, 13])
    words, row = packing._words(ids, offsets, bpe.DEFAULT_TOKENIZER)
    index = packing.Shard(*packing._counted(words, row), 4)
    of = [Counter(words[row == k].tolist()) for k in range(4)]
    mean = np.mean([sum(c.values()) for c in of])
    for q in range(4):
        want = np.zeros(4)
        for t in of[q]:
            df = sum(t in c for c in of)
            idf = max(0, np.log((4 - df + .5) / (df + .5)))
            for k, c in enumerate(of):
                norm = packing.K1 * (1 - packing.B + packing.B * sum(c.values()) / mean)
                want[k] += (df > 1) * idf * c[t] * (packing.K1 + 1) / (c[t] + norm)
        assert index.scores(index.terms_of(q)) == pytest.approx(want)


def word_ids(library, text):
    """Token ids of every word: a token whose first byte is white space, or the
    text's first, begins one."""
    known = bpe.encoder(bpe.DEFAULT_TOKENIZER).token_bytes
    out = []
    for k, i in enumerate(ids_of(library, text)):
        if k == 0 or known[i][:1].isspace():
            out.append(())
        out[-1] += (i,)
    return out


def greedy_fill(docs, window):
    """``docs``: (doc_id, tail size, words) in order. Sequences as lists of
    (doc_id, number of ids), by the definition."""
    of = [Counter(w) for _, _, w in docs]
    n, mean = len(of), max(1, np.mean([sum(c.values()) for c in of]))
    df = Counter(w for c in of for w in c)

    def bm25(q, k):
        out = 0
        for t in of[q].keys() & of[k].keys():
            idf = max(0, np.log((n - df[t] + .5) / (df[t] + .5)))
            norm = packing.K1 * (1 - packing.B + packing.B * sum(of[k].values()) / mean)
            out += idf * of[k][t] * (packing.K1 + 1) / (of[k][t] + norm)
        return round(out, 9)
    unused, out, rest = list(range(n)), [], None
    while unused or rest:
        seed, size = rest or (unused[0], docs[unused[0]][1])
        unused = [k for k in unused if k != seed]
        out.append([(docs[seed][0], min(size, window))])
        room, rest = window - min(size, window), (seed, size - window) if size > window else None
        for k in sorted(unused, key=lambda k: (-bm25(seed, k), k)):
            if room == 0:
                break
            unused.remove(k)
            took = min(room, docs[k][1])
            out[-1].append((docs[k][0], took))
            room -= took
            if took < docs[k][1]:
                rest = (k, docs[k][1] - took)
    return out


def test_greedy_filling_equals_brute_force(docs_of, library):
    rng = np.random.default_rng(7)
    vocabulary = ["apple", "pear", "steel", "iron", "zinc", "cello", "flute", "river", "stone",
                  "cloud", "tiger", "wolf", "bread", "salt", "lamp", "chair"]
    texts = [" ".join(rng.choice(vocabulary[a:a + 7], rng.integers(3, 150)))
             for a in rng.integers(0, 10, 60)]
    window = 64
    stored = packing.tails(docs_of(texts), window=window).coalesce(1).sortWithinPartitions(
        "shard_key", "near_key", "doc_id", "tail")
    order = [r.doc_id for r in stored.collect()]
    seq = defaultdict(list)
    for r in packing.pack(stored, window=window).collect():
        if not (r.length == window and r.start % window == 0
                and r.start + window <= r.doc_tokens - r.doc_tokens % window):
            seq[r.sequence_id].append((r.offset, r.doc_id, r.length))
    docs = [(i, (len(ids_of(library, texts[i])) + 1) % window, word_ids(library, texts[i]))
            for i in order]
    want = greedy_fill([d for d in docs if d[1]], window)
    assert [[(i, n) for _, i, n in sorted(seq[s])] for s in sorted(seq)] == want


def test_words_are_counted_over_the_whole_document(docs_of, library):
    topics = ["red apple pear plum fig", "steel copper iron zinc tin", "violin cello flute oboe"]
    texts = [" ".join([t] * 12) for _ in range(6) for t in topics]
    window = 32
    rows = packing.tails(docs_of(texts), window=window).collect()
    assert all(r.doc_tokens > window for r in rows)
    for r in rows:
        words = Counter(word_ids(library, texts[r.doc_id]))
        assert len(r.terms) == 4 * len(words) and len(r.counts) == 2 * len(words)
        assert sorted(np.frombuffer(r.counts, "<u2").tolist()) == sorted(words.values())


def test_shards_of_few_terms_keep_every_id(small_docs, library):
    texts = {r.doc_id: r.text for r in small_docs.select("doc_id", "text").collect()}
    rows = packing.pack(packing.tails(small_docs, window=128), window=128, shard_terms=300)
    check_pieces(rows.collect(), texts, library, 128)
