"""Filter interaction audit: what each filter removes under every order.

Whatever the order, a document falls at its first failing filter. So with masks
M (a row for each set of failing filters: 0 for a filter that fails, infinity
for one that does not) and positions P (a row for each order: the place of each
filter in it, the inverse of the order as a permutation), the min-plus product

    R[mask, order] = min over filters f of M[mask, f] + P[order, f]

is the step that removes the documents with that mask, infinity if none does.
R is the same for any corpus. The corpus enters as weights only: how many
documents of a part have each mask. Scattering the weights to (order, R) gives
what each step removes, and sums over masks the rest. Tasks need a part's
weights alone, at most one row for each mask.

The masks of the documents come from one pass over the texts. Whether a text is
a copy of one with a smaller doc_id is decided by aggregation: rows are counted
by text digest and flags, with the smallest doc_id and the number of rows that
have it. Equal texts are thus combined before any shuffle, and no row is joined
to its copies.

Cases: a null text is empty, and equal to any empty one; a null lang is the
part of the empty string; a null doc_id is neither smaller nor larger than
another and has no labels; rows with the same doc_id and text are no copies of
each other, but each counts; a document is good or toxic if any row of the
labels says so; a very long text is split into words some megabytes at a time;
texts are told apart by 128-bit digests; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covtab.llm.scratch import staged
from covtab.llm.textcore import as_bytes

# The filters and their bounds.
FILTERS = "ABCDE"
COPY = FILTERS.index("E")
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
MARKS = b"#$%&*|"

MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_INSIDE_CHARS = bytes(range(0x80, 0xC0))  # all but a character's first byte
_BLOCK = 1 << 22


def _blocks(raw: bytes) -> Iterator[bytes]:
    """``raw`` in blocks that end between words."""
    at = 0
    while at < len(raw):
        gap = _GAP.search(raw, at + _BLOCK)
        end = gap.start() if gap else len(raw)
        yield raw[at:end]
        at = end


def text_mask(raw: bytes) -> int:
    """Bits of the filters that a text fails, all but the one for copies.
    ``bytes.split`` parts at the same characters as the word rule."""
    n, distinct = 0, set()
    for block in _blocks(raw):
        found = block.split()
        n += len(found)
        distinct.update(found)
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    points = len(raw.translate(None, _INSIDE_CHARS))
    fails = (n < MIN_WORDS, 100 * len(distinct) < MIN_DISTINCT_PERCENT * n,
             100 * capitals > MAX_CAPITAL_PERCENT * points,
             len(raw.translate(None, MARKS)) < len(raw))
    return sum(1 << f for f, failing in enumerate(fails) if failing)


def _flagged(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``mask`` without copies, ``digest`` and ``n``, the
    number of such rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = as_bytes(batch.column("text"))
            masks, digests = [], []
            for a, b in itertools.pairwise(offsets.tolist()):
                raw = data[a:b].tobytes()
                masks.append(text_mask(raw))
                digests.append(hashlib.blake2b(raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()),
                 pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                         F.col("text").cast("string").alias("text"))
    return (narrow.mapInArrow(run, "doc_id long, part string, mask int, digest binary")
            .groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n")))


def _labelled(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """With ``good`` and ``toxic`` (0 or 1) from the labels. Rows without a
    doc_id have none; their digests part them among the tasks of the join."""
    marks = (labels.where(F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("key"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
             .withColumn("apart", F.lit(None).cast("binary")))
    rows = (flagged.withColumn("key", F.coalesce("doc_id", F.lit(0)))
            .withColumn("apart", F.when(F.col("doc_id").isNull(), F.col("digest"))))
    same = rows["key"].eqNullSafe(marks["key"]) & rows["apart"].eqNullSafe(marks["apart"])
    return rows.join(marks, same, "left").select(
        "doc_id", "part", "mask", "digest", "n", F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"))


def mask_weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask`` (bit f set where filter f fails), and the ``n``,
    ``good`` and ``toxic`` documents with it."""
    rows = staged(_labelled(_flagged(docs), labels), "audit-rows")
    # A text's flags are all the same, so its copies fall into one row for each
    # part and label; the first doc_id's rows are counted on the way.
    copies = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("no_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    least = F.col("least.doc_id")
    first = F.min(least).over(Window.partitionBy("digest"))
    alone = F.coalesce("no_id", F.lit(0)) + F.when(least == first, F.col("least.n")).otherwise(0)
    parted = copies.withColumn("alone", alone)
    both = F.explode(F.array(
        F.struct(F.col("mask"), F.col("alone").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(1 << COPY)).alias("mask"),
                 (F.col("n") - F.col("alone")).alias("n"))))
    return (parted.select("part", "good", "toxic", both.alias("x")).where("x.n > 0")
            .groupBy("part", F.col("x.mask").alias("mask"))
            .agg(F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"),
                 F.sum(F.col("x.n") * F.col("toxic")).alias("toxic")))


def removal_steps(n_filters: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of the filters, and R: for each mask and order the step
    (from 1) that removes, ``n_filters + 1`` where none does."""
    orders = list(itertools.permutations(range(n_filters)))
    places = np.argsort(np.array(orders, np.int64).reshape(len(orders), n_filters), axis=1) + 1
    bits = (np.arange(1 << n_filters)[:, None] >> np.arange(n_filters)) & 1
    masks = np.where(bits == 1, 0, n_filters + 1)
    steps = np.full((len(masks), len(orders)), n_filters + 1)
    for f in range(n_filters):
        np.minimum(steps, masks[:, f, None] + places[:, f], out=steps)
    return orders, steps


def interactions(weights: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``part``, ``filter_order``, ``step`` and ``MEASURES``, from the weights
    of the masks of each part."""
    k = len(filters)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        orders, steps = removal_steps(k)
        order = np.array(orders)
        mask = rows["mask"].to_numpy()
        step = steps[mask]
        index = np.broadcast_to(np.arange(len(orders)), step.shape)

        def scattered(column: str) -> np.ndarray:
            out = np.zeros((len(orders), k + 2), np.int64)
            weight = np.broadcast_to(rows[column].to_numpy(np.int64)[:, None], step.shape)
            np.add.at(out, (index, step), weight)
            return out[:, 1:k + 1]
        n = rows["n"].to_numpy(np.int64)
        removed = scattered("n")
        fails = np.array([n[mask >> f & 1 == 1].sum() for f in range(k)])
        unique = np.array([n[mask == 1 << f].sum() for f in range(k)])
        shapley = np.zeros(k, np.int64)
        np.add.at(shapley, order, removed)
        # What fails a filter and is still there when it comes, it removes.
        values = {"kept": n.sum() - removed.cumsum(axis=1), "removed": removed,
                  "redundant": fails[order] - removed, "unique_fails": unique[order],
                  "good_lost": scattered("good"), "toxic_lost": scattered("toxic"),
                  "shapley": shapley[order]}
        names = ["".join(filters[f] for f in o) for o in orders]
        return pd.DataFrame({
            "part": rows["part"].iloc[0], "filter_order": np.repeat(names, k),
            "step": np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders)),
            **{m: values[m].ravel() for m in MEASURES}})
    return weights.groupBy("part").applyInPandas(
        run, "part string, filter_order string, step int, "
             + ", ".join(f"{m} long" for m in MEASURES))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of ``FILTERS`` over all documents."""
    return interactions(mask_weights(docs, labels))
