"""Split points of the publishing shuffle from the BigWig indexes (O1, K1).

A range shuffle has to know where to cut before it moves a row, and Spark finds
out by reading all of them once more for a sample. The R-trees of the inputs say
it beforehand: the index stage notes, for each byte range of blocks, stretches
of blocks with chromosome, start and compressed bytes. Summed over all files of
a table, they tell how the rows of each (table, chromosome) spread over the
starts.

The starts are cut into bins of one width. Each (table, chromosome) gets an
array of the bytes before each bin, counted over all tables in published order.
A row's place in that count, interpolated within its bin, over the bytes that
one partition is to hold, is its partition. The place never falls as table,
chromosome or start rise, so partitions follow each other in published order
whatever the index says; a poor index makes them uneven, not wrong. Rows of one
start stay together: at most a few for each file of the table.

The arrays are broadcast. They hold at most ``MAX_CELLS`` numbers; with more
(table, chromosome) pairs than ``MAX_ROWS`` Spark's sampling is used instead.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covtab.functions.chrom import normalize_chrom, order_rank

MAX_CELLS = 1 << 20  # of 8 bytes
MAX_ROWS = 1 << 15
_MIN_BINS, _MAX_BINS = 8, 4096


@dataclass(frozen=True)
class RangeBounds:
    """``arrays``: the group columns, ``rank`` and ``before``, the bytes ahead
    of each bin's begin (one more for the end of the last)."""
    arrays: DataFrame
    group_cols: list[str]
    bins: int
    width: int
    total: float

    def deal(self, rows: DataFrame, n: int, chrom: str = "seqnames", start: str = "start"
             ) -> DataFrame:
        """``rows`` in ``n`` partitions that follow each other in published
        order."""
        rank = order_rank(chrom)
        a = F.broadcast(self.arrays)
        match = a["rank"] == rank
        for c in self.group_cols:
            match = match & rows[c].eqNullSafe(a[c])
        joined = rows.join(a, match, "left").select(*[rows[c] for c in rows.columns], "before")
        at = F.greatest(F.col(start).cast("long"), F.lit(0))
        # The index counts from 0, the rows from 1: the same bins to within one.
        k = F.least((at / self.width).cast("int"), F.lit(self.bins - 1))
        share = F.least((at - k * F.lit(self.width)) / F.lit(float(self.width)), F.lit(1.0))
        low, high = F.get("before", k), F.get("before", k + 1)
        place = (low + (high - low) * share) / F.lit(max(self.total, 1.0) / n)
        part: Column = F.least(F.coalesce(place, F.lit(0.0)).cast("int"), F.lit(n - 1))
        # The number is taken in the join's own projection: no array is shuffled.
        return (joined.select(*rows.columns, part.alias("range_number"))
                .repartitionById(n, "range_number").select(*rows.columns))


def stretches(chunks: DataFrame, files: DataFrame, group_cols: list[str]) -> DataFrame:
    """``group_cols``, ``rank``, ``start``, ``bytes`` of the chunks' stretches of
    blocks, once for each group that a file belongs to."""
    each = (chunks.where(F.col("error").isNull())
            .select("file_path", F.explode("stretches").alias("s"))
            .select("file_path", "s.*"))
    return (each.join(files.select("file_path", *group_cols).distinct(), "file_path")
            .select(*group_cols, order_rank(normalize_chrom(F.col("chrom"))).alias("rank"),
                    "start", "bytes"))


def index_bounds(chunks: DataFrame, files: DataFrame, group_cols: list[str]
                 ) -> RangeBounds | None:
    """The split points for publishing what ``chunks`` hold, or None where
    sampling must do."""
    found = stretches(chunks, files, group_cols)
    keys = [*group_cols, "rank"]
    totals = found.groupBy(*keys).agg(F.sum("bytes").alias("bytes"),
                                      F.max("start").alias("last")).checkpoint(eager=True)
    whole = totals.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"),
                       F.max("last").alias("last")).first()
    if not whole["n"] or whole["n"] > MAX_ROWS:
        return None
    bins = max(_MIN_BINS, min(_MAX_BINS, MAX_CELLS // whole["n"] - 1))
    width = int(whole["last"]) // bins + 1
    binned = (found.groupBy(*keys, (F.col("start") / width).cast("int").alias("bin"))
              .agg(F.sum("bytes").cast("double").alias("bytes")))
    # At most MAX_ROWS narrow rows, so one window over all of them.
    ahead = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    begin = totals.select(*keys, F.coalesce(F.sum("bytes").over(ahead), F.lit(0))
                          .cast("double").alias("begin"))
    key_types = ", ".join(f"{c} string" for c in group_cols)

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        weight = np.bincount(rows["bin"], weights=rows["bytes"], minlength=bins)
        before = rows["begin"].iloc[0] + np.concatenate(([0.0], np.cumsum(weight)))
        return rows[keys].head(1).assign(before=[before])
    match = [binned[c].eqNullSafe(begin[c]) for c in keys]
    arrays = (binned.join(begin, match).select(*[binned[c] for c in keys], "bin", "bytes", "begin")
              .groupBy(*keys).applyInPandas(fill, f"{key_types}{', ' if key_types else ''}"
                                                  "rank int, before array<double>"))
    return RangeBounds(arrays.checkpoint(eager=True), list(group_cols), bins, width,
                       float(whole["bytes"]))
