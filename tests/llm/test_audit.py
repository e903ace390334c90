"""The audit against filters applied one by one, order by order."""
import itertools
import random
import re
from collections import Counter

from covtab.llm import audit
from tests.llm.conftest import EDGE_TEXTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, part string, mask int, n int, good string"
LABELS = "doc_id long, quality int, toxic int, n string"


def applied(rows, marks):
    """Rows (part, order, step, measures) of documents (doc_id, text, lang)."""
    docs = []
    for i, text, lang in rows:
        text = text or ""
        w = WORD.findall(text)
        smaller = any(j is not None and i is not None and j < i and (t or "") == text
                      for j, t, _ in rows)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
                 "D": any(c in text for c in "#$%&*|"), "E": smaller}
        mine = [m for m in marks if i is not None and m[0] == i]
        docs.append((lang or "", {f for f in fails if fails[f]},
                     any(m[1] == 1 for m in mine), any(m[2] == 1 for m in mine)))
    out, total = {}, Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[part, f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[1] for d in own) - len(gone),
                    sum(d[1] == {f} for d in own), sum(d[2] for d in gone),
                    sum(d[3] for d in gone)]
    return {(p, o, s): (*v, total[p, o[s - 1]]) for (p, o, s), v in out.items()}


def check(docs, labels):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    marks = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    out = audit.audit(docs, labels)
    assert out.dtypes == [("part", "string"), ("filter_order", "string"), ("step", "int"),
                          *[(m, "bigint") for m in audit.MEASURES]]
    got = out.collect()
    want = applied(rows, marks)
    assert len(got) == len(want)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == want
    return want


def test_all_orders(spark):
    rng = random.Random(2)
    made = [" ".join(rng.choice(["w%d" % k for k in range(rng.choice([9, 900]))])
                     for _ in range(rng.choice([199, 200, 400])))
            + rng.choice(["", "", " $", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 4]) for _ in range(30)]
    made += EDGE_TEXTS + ["é" * 97 + "ABC", "é" * 96 + "ABCD"]
    rows = [(rng.choice([None, *range(60)]), rng.choice(made),
             rng.choice(["en", "en", None, "", "fr"]), "p", 1, 2, "g") for _ in range(150)]
    rows += rows[:20]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = [(rng.choice([None, *range(70)]), rng.choice([0, 1, None]), rng.choice([0, 1, None]),
              "x") for _ in range(90)]
    labels = spark.createDataFrame(marks, LABELS)
    want = check(docs, labels)
    assert len({k[0] for k in want}) == 3
    check(docs, labels.limit(0))
    check(docs.limit(0), labels)


def test_given_documents(spark, small_docs):
    check(small_docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))


def test_removal_steps_of_any_number_of_filters():
    for k in range(5):
        orders, steps = audit.removal_steps(k)
        for mask in range(1 << k):
            for o, order in enumerate(orders):
                hits = [s for s, f in enumerate(order, 1) if mask >> f & 1]
                assert steps[mask, o] == min(hits, default=k + 1)


def test_words_of_a_long_text_do_not_depend_on_blocks(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab \n\t#Aé") for _ in range(n)) for n in (0, 1, 50, 900) * 5]
    whole = [audit.text_mask(t.encode()) for t in texts]
    monkeypatch.setattr(audit, "_BLOCK", 7)
    assert [audit.text_mask(t.encode()) for t in texts] == whole
