"""Near-duplicate groups by SuperMinHash, banding, exact verification and
connected components.

1. One pass over the texts gives each document its set of word shingles, as
   hashes, its digest and the hashes of its signature's bands.
2. Documents with equal sets form a class; its smallest doc_id stands for it,
   so a mass of exact copies never reaches the candidate search.
3. Representatives that share a band share a bucket. Each bucket's leader is
   the member that shares most with all its buckets; every member is verified
   against the leader on the full sets. That is linear in the bucket.
4. Verified links are joined to components. Where a bucket still holds more
   than one, the pairs across them that could be linked come from an exact
   join on the sets' rarest shingles, and are verified too. No pair of a bucket
   stays undecided, and none is enumerated that cannot be linked.

With the standard 32 bands of 5 values a pair of similarity 0.8 shares no
bucket with probability 3e-6.

Texts are read twice: for the signatures, and for the sets of the documents in
pairs. Pairs are verified on these sets. A leader's set comes once before the
sets of its members, in tasks of at most ``MEMBERS`` of them, so a task holds one
leader's set and one batch of others, whatever the length of the texts or the
size of a bucket.

Cases: documents without words or text have an empty set and are linked with
nothing; repeated rows get a row each; rows that repeat a doc_id, or have none,
are judged each by its own text and are written once under row numbers for it;
the component of a row without a doc_id is the smallest doc_id reachable, or null
if there is none, and of a group without any doc_id one row is kept; a very long
text is one row of a batch and its set is held whole; ties are settled by the
smaller doc_id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covtab.llm.components import connected_components
from covtab.llm.scratch import Workspace, bound_batches, staged
from covtab.llm.shingles import band_hashes, set_digests, shingle_sets, super_minhash
from covtab.llm.textcore import text_slices

SHINGLE_WORDS = 5
MIN_PERCENT = 80
BANDS, BAND_WIDTH = 32, 5
FILTER_CELLS = 1 << 16  # of 12 bytes: bounds the broadcast filter of ids
MEMBERS = 2048  # about, of one leader, that one task verifies


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def signatures(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, bands: int = BANDS,
               band_width: int = BAND_WIDTH) -> DataFrame:
    """``doc_id``, ``n_shingles``, the set's digest ``d1``, ``d2``, and
    ``bands`` (hashes of its signature's bands; none for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column("text")):
                h, first = shingle_sets(data, offsets, shingle_words)
                n = np.diff(first)
                d1, d2 = set_digests(h, first)
                sig = super_minhash(h, first, bands * band_width)
                keys = band_hashes(sig, bands, band_width)[n > 0].ravel()
                ends = np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(n.astype(np.int64)),
                     pa.array(d1), pa.array(d2),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys))],
                    ["doc_id", "n_shingles", "d1", "d2", "bands"])
    return _documents(docs).mapInArrow(
        run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>")


def shingle_tables(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``set``, the sorted 64-bit hashes of its shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column("text")):
                h, first = shingle_sets(data, offsets, shingle_words)
                sets = [h[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(sets, pa.binary())],
                    ["doc_id", "set"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, set binary")


def _set_of(column: pa.Array, k: int) -> np.ndarray:
    return np.frombuffer(column[k].as_buffer(), np.uint64)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a``, ``b``, ``shared``, ``total`` (sizes of the intersection and the
    union of the full sets) of every pair ``a``, ``b`` of doc_ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, x = None, np.zeros(0, np.uint64)
        for batch in batches:
            a_ids, b_ids = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            column, out = batch.column("set"), []
            for k, (a, b) in enumerate(zip(a_ids, b_ids, strict=True)):
                y = _set_of(column, k)
                if b is None:
                    leader, x = a, y.copy()
                    continue
                if a != leader:
                    raise RuntimeError(f"the set of {a} does not come before its members")
                both = 0
                if len(x):
                    at = np.searchsorted(x, y)
                    at[at == len(x)] = 0
                    both = int(np.count_nonzero(x[at] == y))
                out.append((a, b, both, len(x) + len(y) - both))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                    ["a", "b", "shared", "total"])
    share = F.ceil(F.count("*") / F.lit(MEMBERS)).cast("int")
    shares = pairs.groupBy("a").agg(share.alias("shares"))
    deal = F.pmod(F.xxhash64("b"), F.col("shares")).cast("int")
    members = (pairs.join(shares, "a").select("a", deal.alias("share"), "b")
               .join(sets.withColumnRenamed("doc_id", "b"), "b"))
    leaders = (shares.join(sets.withColumnRenamed("doc_id", "a"), "a")
               .select("a", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
                       F.lit(None).cast("long").alias("b"), "set"))
    # Nulls sort first: each leader before its members.
    dealt = (members.select("a", "share", "b", "set").unionByName(leaders)
             .repartition("a", "share").sortWithinPartitions("a", "share", "b"))
    return dealt.select("a", "b", "set").mapInArrow(run, "a long, b long, shared long, total long")


def _linked(verified: DataFrame, percent: int) -> DataFrame:
    return verified.where(F.col("shared") * 100 >= F.col("total") * percent).select("a", "b")


def _open_documents(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component: ``rep``, ``c``
    (its component) and ``outside`` (in another one than some leader).
    ``members``: bucket, rep, leader, members."""
    comp = components.select(F.col("node").alias("rep"), "component")
    of_leader = components.select(F.col("node").alias("leader"),
                                  F.col("component").alias("leader_component"))
    # In a bucket of two, the leader has met the only other member.
    rows = (members.where(F.col("members") > 2).where(F.col("rep") != F.col("leader"))
            .join(comp, "rep", "left").join(of_leader, "leader", "left")
            .select("bucket", "rep", F.coalesce("component", "rep").alias("c"),
                    F.coalesce("leader_component", "leader").alias("lc")))
    spread = (rows.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
              .where(F.col("lo") != F.col("hi")).select("bucket"))
    return (rows.join(spread, "bucket", "left_semi").groupBy("rep")
            .agg(F.min("c").alias("c"), F.max(F.col("c") != F.col("lc")).alias("outside")))


def _open_pairs(documents: DataFrame, sets: DataFrame, percent: int, work: Workspace
                ) -> DataFrame:
    """Pairs ``a``, ``b`` in different components, one of them outside, that
    could still be linked. With shingles in one order for all sets, rarest
    first, linked sets share a shingle so early that enough others follow it
    in both; all such pairs, and few others, come from a join on the early
    shingles. Of two sets, the smaller one's early part is the shorter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, rep in enumerate(batch.column("rep").to_pylist()):
                h = _set_of(batch.column("set"), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), rep, np.int64)),
                     pa.array(np.full(len(h), len(h), np.int64)), pa.array(h.view(np.int64))],
                    ["rep", "n", "shingle"])
    rows = (sets.withColumnRenamed("doc_id", "rep").join(documents.select("rep"), "rep", "left_semi")
            .select("rep", "set").mapInArrow(run, "rep long, n long, shingle long"))
    rows = work.staged(rows, "open-shingles")
    times = rows.groupBy("shingle").agg(F.count("*").alias("times"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("times", "shingle")) - 1
    t = percent / 100

    def rest(share: float) -> Column:
        return F.col("n") - F.ceil(F.col("n") * share - 1e-9)
    early = (rows.join(times, "shingle").withColumn("at", place)
             .where(F.col("at") <= rest(t))
             .withColumn("short", F.col("at") <= rest(2 * t / (1 + t)))
             .join(documents, "rep"))
    early = work.staged(early.select("rep", "n", "shingle", "at", "short", "c", "outside"),
                        "early-shingles")

    def side(x: str) -> DataFrame:
        return early.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in
                                         ("rep", "n", "at", "short", "c", "outside")])
    least = F.ceil((F.col("n_a") + F.col("n_b")) * (t / (1 + t)) - 1e-9)
    ok = ((F.col("c_a") != F.col("c_b")) & (~F.col("outside_b") | (F.col("rep_a") < F.col("rep_b")))
          & (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
          & (F.col("n_a") - F.col("at_a") >= least) & (F.col("n_b") - F.col("at_b") >= least))
    a, b = side("a").where("outside_a"), side("b")
    smaller = a.where("short_a").join(b, "shingle").where(ok & (F.col("n_a") <= F.col("n_b")))
    larger = a.join(b.where("short_b"), "shingle").where(ok & (F.col("n_a") > F.col("n_b")))
    return (smaller.unionByName(larger)
            .select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct())


def _near(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with the given ids and, as long as these are few, few
    others: what a broadcast filter of at most ``FILTER_CELLS`` cells passes. No
    text is shuffled."""
    slot = F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(FILTER_CELLS * 60).cast("long"))
    cell = F.floor(slot / 60).cast("int")
    mark = F.pow(F.lit(2.0), slot % 60).cast("long")
    cells = ids.select(cell.alias("cell"), mark.alias("mark")).groupBy("cell").agg(
        F.bit_or("mark").alias("marks"))
    return (docs.withColumn("cell", cell).join(F.broadcast(cells), "cell")
            .where(F.col("marks").bitwiseAND(mark) != 0).select(*docs.columns))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                    percent: int = MIN_PERCENT, bands: int = BANDS,
                    band_width: int = BAND_WIDTH) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest
    doc_id reachable over links of similarity ``percent`` or more) and ``kept``
    (whether it is that document)."""
    spark = docs.sparkSession
    named, work = _documents(docs), Workspace(spark)
    how = (shingle_words, percent, bands, band_width)
    seen = named.agg(F.count("*").alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    if seen["rows"] == seen["ids"]:
        return _grouped(named, *how)
    numbered = work.staged(named.withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = _grouped(numbered.select(F.col("row").alias("doc_id"), "text"), *how)
    rows = (found.select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("c"))
            .join(numbered.select("row", "doc_id"), "row"))
    groups = rows.groupBy("c").agg(F.min("doc_id").alias("component_id"),
                                   F.min("row").alias("first"))
    kept = F.when(F.col("component_id").isNull(), F.col("row") == F.col("first")).otherwise(
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    out = staged(rows.join(groups, "c").select("doc_id", "n_shingles", "component_id",
                                               kept.alias("kept")), "near-duplicates")
    work.clear()
    return out


def _grouped(docs: DataFrame, *how) -> DataFrame:
    """``near_duplicates`` of documents with distinct doc_ids."""
    bound_batches(docs.sparkSession)
    work = Workspace(docs.sparkSession)
    out = staged(_components(docs, *how, work), "near-duplicates")
    work.clear()
    return out


def _components(docs: DataFrame, shingle_words: int, percent: int, bands: int, band_width: int,
                work: Workspace) -> DataFrame:
    sig = work.staged(signatures(docs, shingle_words, bands, band_width), "signatures")
    key = ["d1", "d2", "n_shingles"]
    classes = work.staged(sig.where("n_shingles > 0").groupBy(*key)
                          .agg(F.min("doc_id").alias("rep")), "classes")
    reps = sig.join(classes.withColumnRenamed("rep", "doc_id"), [*key, "doc_id"], "left_semi")
    buckets = reps.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"),
                          F.explode("bands").alias("bucket"))
    shared = (buckets.groupBy("bucket").agg(F.count("*").alias("members"))
              .where("members > 1"))
    members = work.staged(buckets.join(shared, "bucket"), "buckets")
    weight = members.groupBy("rep").agg(F.sum("members").alias("weight"))
    leaders = (members.join(weight, "rep").groupBy("bucket")
               .agg(F.min(F.struct((-F.col("weight")).alias("w"), "rep"))["rep"].alias("leader")))
    led = work.staged(members.join(leaders, "bucket"), "led-buckets")
    pairs = work.staged(led.where(F.col("rep") != F.col("leader"))
                        .select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct(),
                        "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = work.staged(shingle_tables(_near(docs, ids), shingle_words), "sets")
    verified = work.staged(verify(pairs, sets), "verified")
    links = _linked(verified, percent)
    components = connected_components(links)
    open_ = work.staged(_open_documents(led, components), "open-documents")
    if open_.limit(1).count():
        more = _open_pairs(open_, sets, percent, work)
        further = _linked(verify(more, sets), percent)
        components = connected_components(links.unionByName(further))
    of_rep = components.select(F.col("node").alias("rep"), "component")
    component = F.coalesce("component", "rep", "doc_id")
    return (sig.select("doc_id", *key).join(classes, key, "left").join(of_rep, "rep", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    (F.col("doc_id") == component).alias("kept")))


def keep_one_of_each(docs: DataFrame, shingle_words: int = SHINGLE_WORDS,
                     percent: int = MIN_PERCENT, bands: int = BANDS,
                     band_width: int = BAND_WIDTH) -> DataFrame:
    """The documents of which one stands for each group, columns unchanged.
    Every row is judged by its own text: of a group's rows the one with the
    smallest doc_id stays (null last), of several with that doc_id the one whose
    text has the smallest hash. Texts without words have no group: they stay,
    once for each doc_id and text, and each where doc_id is null."""
    row = "row"
    while row in docs.columns:
        row += "_"
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    doc_id = F.col("doc_id").cast("long")
    keys = rows.select(F.col(row).alias("node"), doc_id.alias("own"),
                       F.xxhash64(F.col("text").cast("string")).alias("h"))
    texts = rows.select(F.col(row).alias("doc_id"), F.col("text").cast("string").alias("text"))
    judged = _grouped(texts, shingle_words, percent, bands, band_width).select(
        F.col("doc_id").alias("node"), "component_id", "n_shingles")
    grouped = F.when((F.col("n_shingles") > 0) | F.col("own").isNull(), F.col("component_id"))
    alone = grouped.isNull()
    kept = (judged.join(keys, "node")
            .groupBy(grouped.alias("c"), F.when(alone, F.col("own")).alias("d"),
                     F.when(alone, F.col("h")).alias("t"))
            .agg(F.min(F.struct(F.col("own").isNull().alias("none"), "own", "h", "node"))["node"]
                 .alias(row)))
    return rows.join(kept.select(row), row, "left_semi").select(*docs.columns)
