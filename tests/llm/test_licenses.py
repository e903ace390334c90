"""License scans against every block compared to every template."""
import random
import re

import pytest

from covtab.llm import licenses
from tests.llm.conftest import EDGE_TEXTS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def matches(w, templates, block_words, percent):
    half, out = block_words // 2, set()
    for b in range(-(-len(w) // half)):
        have = set(w[b * half:b * half + block_words])
        for t, (_, text) in enumerate(templates):
            need = set(text.split())
            if 100 * len(have & need) >= percent * len(need):
                out.add((b, t, len(have & need)))
    return sorted(out)


def verdict(text):
    w = words_of(text)
    places = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(w))
              if w[i:i + len(phrase.split())] == phrase.split()]
    found = matches(w, licenses.TEMPLATES, licenses.BLOCK_WORDS, licenses.MIN_PERCENT)
    base = {label for _, label in places}
    more = {licenses.TEMPLATES[t][0] for _, t, _ in found}
    share = [k / len(set(licenses.TEMPLATES[t][1].split())) for _, t, k in found]
    at = [i for i, _ in places]
    return (len(w), len(at), min(at, default=None), max(at, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | more)),
            1.0 if at else max(share, default=0.0))


def check(docs):
    want = sorted((repr(r.doc_id), *map(repr, verdict(r.text)))
                  for r in docs.select("doc_id", "text").collect())
    index = licenses.build_index(docs)
    out = licenses.license_labels(licenses.license_matches(docs, index), index)
    assert out.dtypes == [("doc_id", "bigint"), ("n_words", "bigint"), ("n_base", "bigint"),
                          ("first_word", "bigint"), ("last_word", "bigint"),
                          ("base_labels", "string"), ("labels", "string"), ("score", "double")]
    assert sorted(tuple(map(repr, r)) for r in out.collect()) == want
    return want


def made_texts():
    rng = random.Random(5)
    out = list(EDGE_TEXTS) + [(None, "CC BY"), (None, None), (7, "All-rights, RESERVED"), (7, "x")]
    vocabulary = licenses._vocabulary(licenses.TEMPLATES)
    for label, text in licenses.TEMPLATES:
        w = text.split()
        for lost in range(3):  # around the threshold
            rest = w[:]
            for _ in range(lost):
                rest.pop(rng.randrange(len(rest)))
            if lost:
                rest.insert(rng.randrange(len(rest)), "zzz")
            pad = ["lorem"] * rng.randrange(40)
            out.append(" ".join(pad + rest + pad).upper())
        out.append(" ".join(w[:5]) + " x" * 30 + " " + " ".join(w[5:]))  # torn apart
    for n in (5, 40, 200):
        out += [" ".join(rng.choice(vocabulary) for _ in range(n)) for _ in range(20)]
    out += ["cc by cc by all rights reserved cc", "é cc. by éé", "general public license " * 300,
            "cc", "by", "mit " * 5000]
    return [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(out)]


def test_labels_of_all_texts(docs_of, small_docs):
    want = check(docs_of(made_texts()))
    assert len({w[6] for w in want}) > 15
    check(docs_of([]))
    assert {"'mit'", "'apache-2.0'", "'reserved'"} <= {w[6] for w in check(small_docs)}


@pytest.mark.parametrize("percent", [1, 50, 85, 100])
def test_every_matching_block_is_found(docs_of, percent):
    rng = random.Random(percent)
    letters = [chr(97 + k) * 2 for k in range(26)]
    templates = tuple((f"t{k}", " ".join(rng.sample(letters, rng.randrange(1, 9))))
                      for k in range(12))
    # Words of very unequal counts, so that the order matters.
    texts = [" ".join(letters[min(25, int(rng.expovariate(0.15)))] for _ in range(n))
             for n in (0, 1, 7, 8, 9, 30, 200) for _ in range(6)]
    docs = docs_of(texts)
    index = licenses.build_index(docs, templates, block_words=8, percent=percent)
    rows = licenses.license_matches(docs, index).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [tuple(b) for b in r.blocks] == matches(words_of(texts[r.doc_id]), templates, 8,
                                                       percent)


def test_order_is_rarest_first(docs_of):
    docs = docs_of(["b b c", "b a a a"])
    index = licenses.build_index(docs, (("x", "a b c d"),))
    assert index.order == ("d", "c", "a", "b")


def test_blocks_hold_any_statement():
    assert max(len(t.split()) for _, t in licenses.TEMPLATES) <= licenses.BLOCK_WORDS // 2 + 1
