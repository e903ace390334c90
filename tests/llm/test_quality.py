"""Quality rules against plain Python."""
import random
import re
from collections import Counter

import pytest

from covtab.llm import quality
from tests.llm.conftest import EDGE_TEXTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    times, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if times[x] > 1:
            covered.update(range(i, i + 8))
    stop = {x for s in quality.STOP_WORDS.values() for x in s.split()}
    return {"n_words": len(w), "word_chars": sum(map(len, w)),
            "n_symbols": sum(c in quality.SYMBOLS for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "n_lines": len(lines),
            "n_stop_words": sum(x.lower().strip(quality.STOP_PUNCTUATION) in stop for x in w)}


def kept(c, rules):
    base = c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]
    ok = all((r.low is None or 100 * c[r.numerator] >= r.low * c[r.denominator])
             and (r.high is None or 100 * c[r.numerator] <= r.high * c[r.denominator])
             for r in rules)
    return base, not base and ok


def texts():
    rng = random.Random(4)
    out = list(EDGE_TEXTS)
    for n in (7, 8, 9, 15, 16, 17, 40):
        out += ["a " * n, " ".join(map(str, range(n))), "\n".join(["same line here"] * n)]
    for _ in range(60):
        out.append(" ".join(rng.choice("the of x yy # |".split()) for _ in range(60)))
    out.append(" ".join(f"word{i % 900}" for i in range(4000)))  # long
    return out


def check(docs):
    want = {r.doc_id: counts(r.text) for r in docs.select("doc_id", "text").collect()}
    rows = quality.verdicts(docs).collect()
    assert len(rows) == len(want)
    for r in rows:
        c = want[r.doc_id]
        assert {k: r[k] for k in quality.COUNTS} == c
        assert (r.base_failed, r["kept"]) == kept(c, quality.RULES)


def test_counts_and_verdicts(docs_of, small_docs):
    check(docs_of(texts()))
    check(small_docs)
    check(docs_of([]))


def test_rules_are_data(docs_of):
    docs = docs_of([" ".join(["alpha beta"] * 3 + [f"w{i}" for i in range(30)])])
    strict = (quality.Rule("symbols", "n_symbols", "n_words", 1, None),)
    assert not quality.verdicts(docs, strict).first()["kept"]
    assert quality.verdicts(docs, ()).first()["kept"]


def test_filter_keeps_columns_and_needs_no_python(docs_of):
    docs = docs_of(texts())
    good = quality.keep_good(docs)
    assert good.columns == docs.columns
    want = {r.doc_id for r in quality.verdicts(docs).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == want
    assert "Python" not in quality.verdicts(docs)._jdf.queryExecution().toString()


@pytest.mark.parametrize("n", [8, 9, 24])
def test_overlapping_repeats_are_counted_once(docs_of, n):
    docs = docs_of(["a " * n])
    r = quality.verdicts(docs).first()
    assert r.n_repeat_words == (n if n > 8 else 0)
