"""SuperMinHash near-duplicates against brute force over all pairs."""
import random
import re

import numpy as np
import pytest

from covtab.llm import components, neardup, shingles
from covtab.llm.textcore import as_bytes
from tests.llm.conftest import EDGE_TEXTS

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def brute_force(texts, size, percent=80):
    """``doc_id -> (n_shingles, component_id)``."""
    sets = {i: shingle_set(t, size) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(docs, size):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = neardup.near_duplicates(docs, shingle_words=size).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert len(rows) == len(texts) and got == brute_force(texts, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return got


def words_of(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_small_table_and_edge_cases(docs_of, small_docs):
    for size in (2, 5):
        check(small_docs, size)
        check(docs_of([*EDGE_TEXTS, "WORD", "two words", "Two  WORDS"]), size)
    assert neardup.near_duplicates(docs_of([])).count() == 0


def test_masses_of_copies_and_near_copies(docs_of):
    rng = random.Random(3)
    base = words_of(rng, 80)
    texts = [" ".join(base)] * 60  # exact copies
    for _ in range(80):  # near copies, around the threshold to one another
        x = list(base)
        for _ in range(rng.randint(1, 6)):
            x[rng.randrange(len(x))] = f"z{rng.randrange(10**6)}"
        texts.append(" ".join(x))
    for _ in range(12):  # chains: each differs a little from the one before
        x = words_of(rng, 60)
        for _ in range(6):
            x = x[2:] + words_of(rng, 2)
            texts.append(" ".join(x))
    texts += [" ".join(words_of(rng, 50)) for _ in range(40)]
    rng.shuffle(texts)
    for size in (2, 5):
        check(docs_of(texts), size)


def test_rows_that_repeat_a_doc_id_are_judged_by_their_text(docs_of):
    a, b = "one two three four five six seven", "red green blue black white pink grey"
    rows = neardup.near_duplicates(docs_of([(1, a), (5, a), (5, b), (7, b), (5, a)]),
                                   shingle_words=2).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [
        (1, 1), (5, 1), (5, 1), (5, 5), (7, 5)]


def test_rows_without_a_doc_id_are_nodes_of_their_own(docs_of):
    rng = random.Random(12)
    base = words_of(rng, 60)
    near = [*base[:58], "changed", "words"]
    alone, pair = " ".join(words_of(rng, 30)), " ".join(words_of(rng, 40))
    docs = docs_of([(None, " ".join(base)), (None, " ".join(near)), (3, " ".join(base[:-1])),
                    (None, alone), (None, pair), (None, pair), (None, None), (9, "x"), (9, "y"),
                    (2, " ".join(near)), (2, " ".join(near))])
    rows = neardup.near_duplicates(docs, shingle_words=2).collect()
    got = sorted((str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in rows))
    assert got == sorted(map(str, [
        (None, 59, 2, False), (None, 59, 2, False), (3, 58, 2, False), (2, 59, 2, True),
        (2, 59, 2, True), (None, 29, None, True), (None, 39, None, True),
        (None, 39, None, False), (None, 0, None, True), (9, 1, 9, True), (9, 1, 9, True)]))


def test_a_leader_of_many_members_is_verified_in_shares(docs_of, monkeypatch):
    monkeypatch.setattr(neardup, "MEMBERS", 3)
    rng = random.Random(4)
    base = words_of(rng, 90)
    texts = [" ".join([*base[:k], f"own{k}", *base[k + 1:]]) for k in range(40)]
    check(docs_of(texts), 5)


def test_staged_tables_go(spark, docs_of):
    import os
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = {f for f in os.listdir(folder) if "-" in f}
    neardup.near_duplicates(docs_of(["a b c d e", "a b c d e", "f g h i j k"])).collect()
    left = {f.rsplit("-", 1)[0] for f in set(os.listdir(folder)) - before}
    assert not left & {"signatures", "classes", "buckets", "led-buckets", "pairs", "sets",
                       "verified", "open-documents"}


def test_keep_one_of_each_keeps_columns(docs_of):
    docs = docs_of(["a b c d e f", "a b c d e f", "other words in this one here", None])
    kept = neardup.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]


def test_keep_one_of_each_selects_rows_not_ids(docs_of):
    a, b, c = "a b c d e f", "other words in this one here", "third text that no one else has"
    docs = docs_of([(5, a), (3, a), (5, b), (5, c), (5, c), (None, a), (None, "one more text here"),
                    (None, c), (8, b), (9, None), (9, None), (9, " "), (None, None), (None, None)])
    got = [(r.doc_id, r.text) for r in neardup.keep_one_of_each(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [(3, a), (5, b), (5, c), (None, "one more text here"), (9, None), (9, " "), (None, None),
         (None, None)], key=str)


def test_signature_estimates_similarity_with_less_variance():
    rng, n, share, m = np.random.default_rng(1), 60, 0.6, 64
    seen = []
    for _ in range(300):
        pool = rng.integers(0, 2**63, 2 * n, dtype=np.int64).astype(np.uint64)
        both = int(n * 2 * share / (1 + share))
        x, y = pool[:n], pool[n - both:2 * n - both]
        sig = shingles.super_minhash(np.concatenate((x, y)), np.array([0, n, 2 * n]), m)
        seen.append((sig[0] == sig[1]).mean())
    true = both / (2 * n - both)
    assert np.mean(seen) == pytest.approx(true, abs=0.01)
    assert np.std(seen) < 0.95 * np.sqrt(true * (1 - true) / m)


def test_early_stopping_does_not_change_signatures():
    import pyarrow as pa
    texts = ["a b c", " ".join(f"x{i}" for i in range(500)), "", "p q"]
    data, offsets = as_bytes(pa.array(texts))
    h, first = shingles.shingle_sets(data, offsets, 2)
    together = shingles.super_minhash(h, first, 16)
    for k in range(4):
        alone = shingles.super_minhash(h[first[k]:first[k + 1]],
                                       np.array([0, first[k + 1] - first[k]]), 16)
        assert (alone[0] == together[k]).all()
        ranks = np.sort(np.floor(alone[0]))
        assert len(h[first[k]:first[k + 1]]) != 1 or (ranks == np.arange(16)).all()
    assert np.isinf(together[2]).all()


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, 200 + k) for k in range(1, 30)]
    edges += [(300, 301), (301, 302), (302, 300), (7, 7)]
    edges = [(b, a) if rng.random() < .5 else (a, b) for a, b in edges * 2]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    want = {i: 100 for i in range(101, 141)} | {i: 200 for i in range(201, 230)}
    assert got == want | {301: 300, 302: 300}
    empty = spark.createDataFrame([], "a long, b long")
    assert components.connected_components(empty).count() == 0
