"""Exact token counts from one histogram of encoded lengths.

Documents are encoded once; only (length, documents) pairs are shuffled, after
map-side aggregation. Suffix sums over the histogram answer totals, quantiles
and truncated totals for every context limit without touching a text again:
``sum(min(length, limit))`` is the tokens of shorter documents plus ``limit``
for each longer one. The sums run in two levels (within blocks of lengths,
then over the blocks' totals), so no task orders the whole histogram.

Cases: null and empty texts have length 0 (plus ``extra_tokens``); ties share
a histogram row; an empty table gives an empty histogram, and its totals are
zero and its quantiles null.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covtab.llm.bpe import DEFAULT_TOKENIZER, encode_column, encoder
from covtab.llm.scratch import staged

BLOCK = 1024  # lengths in a block of the two-level sums


def token_lengths(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """``n_tokens`` of every document."""
    def run(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            for _, _, count, _ in encode_column(batch.column("text"), enc, ids=False):
                yield pa.RecordBatch.from_arrays([pa.array(count)], ["n_tokens"])
    return (docs.select(F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "n_tokens long"))


def length_histogram(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER,
                     extra_tokens: int = 0) -> DataFrame:
    """``length``, ``docs``: how many documents encode to each length."""
    counted = (token_lengths(docs, tokenizer)
               .groupBy((F.col("n_tokens") + F.lit(extra_tokens)).alias("length"))
               .agg(F.count("*").alias("docs")))
    # Written once: the sums read it several times.
    return staged(counted, "length-histogram")


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For every length in the histogram, taken as the context limit:
    ``docs_at_least`` and ``tokens_at_least`` (documents of this length or
    more), ``docs_longer``, ``truncated_tokens`` (what all documents keep under
    the limit), ``lost_tokens``, and ``quantile`` (share of documents no
    longer than it)."""
    h = hist.select("length", "docs", (F.col("length") * F.col("docs")).alias("tokens"),
                    F.floor(F.col("length") / F.lit(BLOCK)).cast("long").alias("block"))
    blocks = h.groupBy("block").agg(F.sum("docs").alias("block_docs"),
                                    F.sum("tokens").alias("block_tokens"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("block").rowsBetween(Window.unboundedPreceding,
                                                Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(after), zero).alias("docs_after"),
        F.coalesce(F.sum("block_tokens").over(after), zero).alias("tokens_after"),
        F.sum("block_docs").over(every).alias("all_docs"),
        F.sum("block_tokens").over(every).alias("all_tokens"))
    inside = (Window.partitionBy("block").orderBy(F.desc("length"))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    s = (h.withColumn("docs_in", F.sum("docs").over(inside))
         .withColumn("tokens_in", F.sum("tokens").over(inside)).join(blocks, "block"))
    at_least = F.col("docs_in") + F.col("docs_after")
    tokens_at_least = F.col("tokens_in") + F.col("tokens_after")
    kept = F.col("all_tokens") - tokens_at_least + F.col("length") * at_least
    longer = at_least - F.col("docs")
    return s.select(
        "length", "docs", at_least.alias("docs_at_least"),
        tokens_at_least.alias("tokens_at_least"), longer.alias("docs_longer"),
        kept.alias("truncated_tokens"), (F.col("all_tokens") - kept).alias("lost_tokens"),
        "all_docs", "all_tokens",
        ((F.col("all_docs") - longer) / F.col("all_docs")).alias("quantile"))


def truncated_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """``limit``, ``docs``, ``docs_longer``, ``truncated_tokens`` for a stated
    list of context limits; each is a conditional sum over the histogram."""
    def total(expr):
        return F.coalesce(F.sum(expr), F.lit(0).cast("long"))
    aggs = [F.struct(F.lit(limit).cast("long").alias("limit"), total(F.col("docs")).alias("docs"),
                     total(F.when(F.col("length") > limit, F.col("docs"))).alias("docs_longer"),
                     total(F.least("length", F.lit(limit)) * F.col("docs"))
                     .alias("truncated_tokens")) for limit in limits]
    return hist.agg(F.array(*aggs).alias("x")).select(F.inline("x"))


def length_quantiles(sums: DataFrame, probabilities: list[float]) -> DataFrame:
    """``probability``, ``length``: the smallest length whose share of
    documents reaches each probability (null when there are no documents)."""
    aggs = [F.struct(F.lit(float(p)).alias("probability"),
                     F.min(F.when(F.col("quantile") >= p, F.col("length"))).alias("length"))
            for p in probabilities]
    return sums.agg(F.array(*aggs).alias("x")).select(F.inline("x"))
