"""Nearest neighbours against brute force."""
import math

import numpy as np
import pytest

from covtab.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, k, step):
    ok = {i: [float(x) for x in v] for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
          and any(v)}
    out = {}
    for q in ok:
        if q % step == 0:
            all_ = sorted((-math.fsum(a * b for a, b in zip(ok[q], ok[i], strict=True)), i)
                          for i in ok if i != q)
            out[q] = [(i, -s) for s, i in all_[:k]]
    return out


def answers(df, **parameters):
    out = {}
    for r in sorted(ann.nearest(df, **parameters).collect(), key=lambda r: r["rank"]):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def vectors(n, dims, seed):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dims)).astype(np.float32)
    return [(i, v) for i, v in enumerate(x.tolist())]


def test_finds_all_with_the_test_never_met(spark):
    rows = vectors(300, 6, 1)
    rows += [(1000 + i, rows[7][1]) for i in range(100)]  # a mass of equal vectors
    rows += [(2000, None), (2020, []), (2040, [0.0] * 6), (2060, [float("nan")] * 6),
             (2080, [None] + [1.0] * 5), (2100, [float("inf")] * 6), (None, [1.0] * 6),
             (2120, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows + rows[:20]], SCHEMA)
    df = df.selectExpr("*", "0 AS rank", "1 AS score")
    want = brute_force([r for r in rows if r[0] != 2120], 20, 20)
    got = answers(df, confidence=1 - 1e-12, ratio=1.0, shard_rows=64, query_block=5)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)], 0) for i in range(4)], SCHEMA)
    assert answers(df) == {0: [(1, 1.0), (2, 1.0), (3, 1.0)]}
    assert answers(df.limit(0)) == {}


def test_recall_of_the_query(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute_force([(r.vec_id, r.embedding) for r in df.collect()], 20, 20)
    got = answers(df)
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want]
    assert np.mean(hits) >= 0.9


def test_stopping_test_saves_work_where_vectors_cluster():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 16)) * 6
    x = centres[rng.integers(0, 40, 6000)] + rng.standard_normal((6000, 16)) * 0.3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    best, score, verified = ann.search(x, x[:50], 10, 1.0)
    exact = np.argsort(-(x[:50] @ x.T), axis=1, kind="stable")[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(best, exact, strict=True)]) >= 0.9
    assert verified < 0.5 * 50 * 6000


def test_chi_square_quantile():
    # 95 % points of the distribution.
    for dims, point in ((2, 5.991), (8, 15.507), (16, 26.296)):
        assert ann.chi_square_quantile(0.95, dims) == pytest.approx(point, abs=1e-3)


@pytest.mark.parametrize("sigma, centres, longest", [
    (0, 0, 1), (.2, 0, 1), (.5, 0, 1), (1, 0, 1), (0, 30, 1), (.5, 30, 1), (0, 0, 1000),
    (0, 30, 1000)])
def test_recall_does_not_depend_on_the_norms(sigma, centres, longest):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((8192, 64))
    if centres:
        x = rng.standard_normal((centres, 64))[rng.integers(0, centres, 8192)] + 0.3 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= np.exp(sigma * rng.standard_normal((8192, 1)))
    x[17] *= longest
    best, _, _ = ann.search(x, x[::80], 20, float(np.square(x).sum(axis=1).max()))
    exact = np.argsort(-(x[::80] @ x.T), axis=1, kind="stable")[:, :20]
    hits = [len(set(a) & set(b)) / 20 for a, b in zip(best, exact, strict=True)]
    assert np.mean(hits) >= 0.99


def test_one_very_long_vector_hides_no_others(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (np.array(v) * s).astype(np.float32).tolist()) for (i, v), s in
            zip(vectors(1500, 12, 6), np.exp(0.5 * rng.standard_normal(1500)), strict=True)]
    rows[33] = (33, (np.float32(1000) * np.array(rows[33][1], np.float32)).tolist())
    want = brute_force(rows, 20, 20)
    got = answers(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA), shard_rows=512)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert got.keys() == want.keys() and np.mean(hits) >= 0.99
