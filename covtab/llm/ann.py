"""Approximate largest-inner-product search by stable projections.

Points are projected to ``PROJECTIONS`` dimensions by a Gaussian, hence
2-stable, matrix: a squared projected distance is the true one times a
chi-square variable. Each shard of at most about ``SHARD_ROWS`` points is
indexed by a kd-tree over the projections and the norm, so that a leaf's points
are of like length. With ``M`` a leaf's largest norm and ``d`` the least
distance of its points to the query, no inner product in it is above
``(M^2 + |q|^2 - d^2) / 2``, nor above ``M |q|``. A query takes the leaves in
order of that bound, with ``d`` from the projected distance to the leaf's box,
and verifies their points on the original vectors until the bound of the next
leaf is below the found k-th inner product. The norms are exact, so long vectors
do not blur the others; a point that belongs to the answer, by the factor
``RATIO`` in distance, is left out with probability at most ``1 - CONFIDENCE``.

Equal vectors are one point with its ``k + 1`` smallest ids (a query needs no
others), and equal queries are searched once. Query blocks meet shards in
tasks of bounded size; only the nearest ``k + 1`` of each leave a task.

Cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do those whose length is not the most frequent
one (the larger of two); ties go to the smaller vec_id; rows that repeat a
vec_id with the same vector are one; fewer candidates give fewer ranks; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covtab.llm.scratch import staged

K = 20
QUERY_STEP = 20  # rows whose id is divisible by it are the queries
PROJECTIONS = 8  # even: the chi-square distribution has a closed form
CONFIDENCE = 0.999
RATIO = 1.0  # the test is on the k-th inner product itself
SHARD_ROWS = 8192
QUERY_BLOCK = 4096
LEAF = 64
SEED = 20_240_229
_SEARCH_BLOCK = 256  # queries that a task searches side by side
_ROUNDING = 1e-12  # of the squared norms: what a bound may lack


def chi_square_cdf(x: float, dims: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, dims // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


@lru_cache(maxsize=8)
def chi_square_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, dims) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dims) < p else (low, mid)
    return high


class KdTree:
    """Leaves of a kd-tree: point order, leaf bounds in it, and leaf boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        n = len(points)
        self.order = np.arange(n)
        bounds, todo = [], [(0, n)]
        while todo:
            a, b = todo.pop()
            if b - a <= leaf:
                bounds.append((a, b))
                continue
            own = points[self.order[a:b]]
            axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            mid = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(own[:, axis], mid)]
            todo += [(a + mid, b), (a, a + mid)]
        self.bounds = np.array(bounds, np.int64).reshape(-1, 2)
        self.low = np.stack([points[self.order[a:b]].min(axis=0) for a, b in bounds])
        self.high = np.stack([points[self.order[a:b]].max(axis=0) for a, b in bounds])

    def distances(self, query: np.ndarray) -> np.ndarray:
        """Squared distance from each query to each leaf's box, over the query's
        columns."""
        low, high = self.low[:, :query.shape[1]], self.high[:, :query.shape[1]]
        away = np.maximum(low[None] - query[:, None], query[:, None] - high[None])
        return np.square(np.maximum(away, 0)).sum(axis=2)


def projection(dims: int, m: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dims, m))


def search(points: np.ndarray, queries: np.ndarray, k: int, largest: float = math.inf,
           confidence: float = CONFIDENCE, ratio: float = RATIO) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``k`` nearest points found for each query (row numbers, -1 where
    there are fewer) with their inner products, and how many points were
    verified. ``largest``: a bound on the points' squared norms, if one is known."""
    r = projection(points.shape[1])
    tree = KdTree(np.column_stack((points @ r, np.sqrt(np.square(points).sum(axis=1)))))
    inside = points[tree.order]
    longest = np.minimum(tree.high[:, -1], math.sqrt(largest))
    width = int((tree.bounds[:, 1] - tree.bounds[:, 0]).max())
    limit = chi_square_quantile(confidence, PROJECTIONS) / ratio ** 2
    best = np.full((len(queries), k), -1, np.int64)
    score = np.full((len(queries), k), -np.inf)
    verified = 0
    for a in range(0, len(queries), _SEARCH_BLOCK):
        q = queries[a:a + _SEARCH_BLOCK]
        norm = np.sqrt(np.square(q).sum(axis=1))[:, None]
        squares = longest ** 2 + norm ** 2
        bound = np.minimum((squares - tree.distances(q @ r) / limit) / 2, longest * norm)
        bound += _ROUNDING * squares
        by_bound = np.argsort(-bound, axis=1, kind="stable")
        live = np.arange(len(q))
        ids, top = best[a:a + _SEARCH_BLOCK], score[a:a + _SEARCH_BLOCK]
        for step in range(len(tree.bounds)):
            leaf = by_bound[live, step]
            # No unverified leaf has a larger bound than the next one.
            go = bound[live, leaf] >= top[live, -1]
            live, leaf = live[go], leaf[go]
            if not len(live):
                break
            at = tree.bounds[leaf, 0][:, None] + np.arange(width)
            real = at < tree.bounds[leaf, 1][:, None]
            at = np.minimum(at, len(points) - 1)
            found = np.matmul(inside[at], q[live][:, :, None])[:, :, 0]
            found[~real] = -np.inf
            verified += int(real.sum())
            every = np.concatenate((top[live], found), axis=1)
            names = np.concatenate((ids[live], np.where(real, tree.order[at], -1)), axis=1)
            pick = np.argsort(-every, axis=1, kind="stable")[:, :k]
            top[live] = np.take_along_axis(every, pick, axis=1)
            ids[live] = np.take_along_axis(names, pick, axis=1)
    return best, score, verified


def _usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` (doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where(finite & F.exists("v", lambda x: x != 0.0))
            # One form of zero, so that equal vectors are equal as keys.
            .withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))))
    sizes = (rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"))
             .orderBy(F.desc("n"), F.desc("dims")).limit(1))
    return rows.join(F.broadcast(sizes.select("dims")), F.size("v") == F.col("dims"),
                     "left_semi")


def nearest(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP,
            confidence: float = CONFIDENCE, ratio: float = RATIO, shard_rows: int = SHARD_ROWS,
            query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (inner product in double
    precision): the ``k`` nearest found for every row whose id is divisible by
    ``query_step``."""
    rows = staged(_usable(vectors), "vectors")
    # Points: distinct vectors with their smallest ids.
    order = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    points = staged(
        rows.distinct().withColumn("place", order).where(F.col("place") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("point", F.col("ids")[0]), "points")
    asked = rows.where(F.col("vec_id") % query_step == 0)
    # Every query with the point that has its vector.
    own = staged(asked.join(points.select("v", "point"), "v")
                 .select(F.col("vec_id").alias("query_id"), "point").distinct(), "queries")
    distinct_queries = own.select("point").distinct()
    shards = max(1, -(-points.count() // shard_rows))
    blocks = max(1, -(-distinct_queries.count() // query_block))

    def part(n: int):
        return F.pmod(F.xxhash64("point"), F.lit(n).cast("long"))

    zero = F.lit(0).cast("long")
    to_search = (points.withColumn("shard", part(shards)).withColumn(
        "block", F.explode(F.sequence(zero, zero + (blocks - 1)))))
    queries = (points.join(distinct_queries, "point", "left_semi").select("point", "v")
               .withColumn("block", part(blocks)).withColumn(
                   "shard", F.explode(F.sequence(zero, zero + (shards - 1)))))

    def find(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_point": [], "vec_id": [], "score": []}).astype(
            {"query_point": "int64", "vec_id": "int64", "score": "float64"})
        if not len(p) or not len(q):
            return none
        x, y = np.stack(p["v"].to_numpy()), np.stack(q["q_v"].to_numpy())
        best, score, _ = search(x, y, k + 1, confidence=confidence, ratio=ratio)
        out = []
        for name, vector, found in zip(q["q_point"].tolist(), y.tolist(), best.tolist(),
                                       strict=True):
            rows = [(-math.fsum(map(float.__mul__, vector, x[f].tolist())), i)
                    for f in found if f >= 0 for i in p["ids"].iloc[f]]
            out += [(name, i, -s) for s, i in sorted(rows)[:k + 1]]
        return pd.DataFrame(out, columns=none.columns).astype(none.dtypes)

    # Both sides stem from one table: new names keep their columns apart.
    to_search = to_search.select("shard", "block", "v", "ids")
    queries = queries.toDF(*[f"q_{c}" for c in queries.columns])
    found = (to_search.groupBy("shard", "block")
             .cogroup(queries.groupBy("q_shard", "q_block"))
             .applyInPandas(find, "query_point long, vec_id long, score double"))
    # The nearest k + 1 over all shards; one of them may be the query itself.
    nearer = Window.partitionBy("query_point").orderBy(F.desc("score"), "vec_id")
    top = (found.withColumn("place", F.row_number().over(nearer))
           .where(F.col("place") <= k + 1)
           .select(F.col("query_point").alias("point"), "vec_id", "score", "place"))
    answers = own.join(top, "point").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("place"))
    return (answers.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
