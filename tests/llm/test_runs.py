"""Periodic runs against every stretch and period compared."""
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from covtab.llm import runs
from covtab.llm.textcore import mix64
from tests.llm.conftest import EDGE_TEXTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def every_run(w, least=0):
    """Maximal stretches of each period, the smallest period of each."""
    best = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 3 * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in best.items())


def found(letters):
    w = mix64(np.array(letters, np.uint64) + np.uint64(1))
    return [tuple(r) for r in runs.find_runs(w).tolist()]


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_every_run_of_nested_repeats(data):
    rng = random.Random(data.draw(st.integers(0, 10**9)))
    letters = []
    while len(letters) < 400:
        unit = [rng.randrange(rng.choice([2, 2, 3, 50])) for _ in range(rng.choice(
            [1, 2, 5, 11, 12, 13, 23, 24, 25, 40, 47, 48, 95, 96]))]
        if rng.random() < 0.4:  # a unit that repeats within itself
            unit = (unit[:rng.randrange(1, 8)] * 8)[:rng.randrange(8, 40)] + unit[:3]
        size = int(len(unit) * rng.choice([1, 2, 2.9, 3, 3.1, 4, 7]))
        letters += (unit * 8)[:size]
        letters += [rng.randrange(60) for _ in range(rng.choice([0, 0, 1, 7]))]
    assert found(letters) == every_run(letters)


@pytest.mark.parametrize("q", [1, 2, 3, 8, 11, 12, 23, 24, 47, 48, 64, 95, 96, 100, 191, 192])
@pytest.mark.parametrize("extra", [-1, 0, 1])
def test_the_shortest_run_of_a_period(q, extra):
    rng = random.Random(q)
    unit = [1000 + k for k in range(q - 1)] + [7]
    letters = [2000, 2001] + (unit * 4)[:3 * q + extra] + [2002]
    rng.shuffle(unit)
    assert found(letters) == every_run(letters)


def test_words_of_a_very_long_document():
    letters = list(range(40_000)) + [k % 9_001 for k in range(30_000)] + list(range(5, 40_000))
    assert found(letters) == [(40_000, 70_000, 9_001)]
    assert found([0, 1] * 60_000) == [(0, 120_000, 2)]


def test_words_decide_where_hashes_mislead(monkeypatch):
    rng = random.Random(3)
    letters = [rng.randrange(3) for _ in range(200)] + [k % 17 for k in range(70)]
    want = every_run(letters)

    def far(self, i, j, limit, step):
        return limit
    monkeypatch.setattr(runs._Words, "common", far)
    assert found(letters) == want


def digest(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    all_ = every_run(w, 24)
    drop = {i for s, e, q in all_ for i in range(s + q, e)}
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in all_)
    best = min(((-Fraction(e - s, q), s, q, e - s) for s, e, q in all_), default=None)
    top = (None,) * 4 if best is None else (best[1], best[3], best[2],
                                            int(-best[0] * 1000 // 1))
    kept = " ".join(x for i, x in enumerate(w) if i not in drop)
    return (len(all_), *top, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


def check(docs):
    want = sorted((repr(r.doc_id), digest(r.doc_id, r.text))
                  for r in docs.select("doc_id", "text").collect())
    out = runs.run_digests(runs.periodic_runs(docs, runs.planted_order))
    assert out.dtypes == [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"),
                          ("length", "bigint"), ("period", "bigint"),
                          ("exponent_milli", "bigint"), ("runs_sha256", "string"),
                          ("collapsed_sha256", "string")]
    assert sorted((repr(r.doc_id), tuple(r)[1:]) for r in out.collect()) == want
    return want


def test_digests_of_the_contract(docs_of, small_docs):
    rng = random.Random(8)
    texts = list(EDGE_TEXTS) + [(None, "a b " * 30), (None, None), (5, "same id " * 20), (5, "x y")]
    for _ in range(40):
        unit = " ".join(rng.choice("the of x yy é # 中文".split()) for _ in range(rng.randrange(1, 60)))
        texts.append(" ".join([unit] * rng.randrange(1, 6)) + "\n" + unit)
    texts.append("\t".join(str(k % 700) for k in range(2500)))
    want = check(docs_of([(k if not isinstance(t, tuple) else t[0],
                           t if not isinstance(t, tuple) else t[1])
                          for k, t in enumerate(texts)]))
    assert sum(d[0] > 0 for _, d in want) > 20
    check(docs_of([]))
    assert any(d[0] for _, d in check(small_docs.where("length(text) < 6000")))


def test_runs_and_collapsed_text(docs_of):
    rows = runs.periodic_runs(docs_of(["p  q\n" * 20 + "end", "no run"])).orderBy("doc_id").collect()
    assert [[tuple(x) for x in r.runs] for r in rows] == [[(0, 40, 2)], []]
    assert [r.collapsed for r in rows] == ["p q end", "no run"]
