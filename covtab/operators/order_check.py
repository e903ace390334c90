"""Physical row-order check of published tables.

Rule (per table): over rows in physical order, the chromosome rank (P6) never
decreases, and within equal rank the start never decreases. Reports the counts
of both violation kinds and the first violating row (1-based, over the table's
files in order).

Plan, all of it in the JVM:

1. Rows are dealt by (file, block of ``BLOCK_ROWS`` row indexes), four narrow
   numbers each: two hashes of the file's path stand for it, and the path itself
   and the group columns only come with a file's row 0. ``lag`` within a block
   compares each row with the one before it, and the block shrinks to ONE row:
   first/last (rank, start), row count, violation counts, first violation. Both
   use the same partitioning and order. A hot file is as many blocks as its rows
   need.
2. Blocks of one file are stitched with a window over the file ordered by
   first row: the boundary between two blocks is one more comparison.
3. Files of one table are stitched with a window over the per-table file list
   in file order (directory, then the part number as a number), which also
   yields each file's row offset.

``row_index`` must be dense (0..n-1) within a file, as Parquet's
``_metadata.row_index`` is; the check compares each row with its predecessor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covtab.functions.chrom import order_rank

KIND_RANK = "rank"
KIND_START = "start"


BLOCK_ROWS = 1 << 20


def block_summaries(rows: DataFrame, group_cols: list[str]) -> DataFrame:
    """Stage 1: one summary row for each block of a file's rows."""
    named = F.struct(F.col("file_path"), *[F.col(c).cast("string").alias(c) for c in group_cols])
    row = F.col("row_index").cast("long")
    narrow = rows.select(
        F.xxhash64("file_path").alias("key1"), F.xxhash64(F.lit(1), "file_path").alias("key2"),
        F.floor(row / BLOCK_ROWS).alias("block"), row.alias("row_index"),
        order_rank("seqnames").alias("rank"), F.col("start").cast("long").alias("start"),
        F.when(row == 0, named).alias("file"))
    block = ["key1", "key2", "block"]
    w = Window.partitionBy(*block).orderBy("row_index")
    fell = narrow.withColumn("kind", _violation(
        F.col("rank"), F.col("start"), F.lag("rank").over(w), F.lag("start").over(w)))
    return fell.groupBy(*block).agg(
        F.max("file").alias("file"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("kind") == KIND_RANK).alias("rank_dec"),
        F.count_if(F.col("kind") == KIND_START).alias("start_dec"),
        F.min(F.when(F.col("kind").isNotNull(), F.struct("row_index", "kind"))).alias("bad"),
        F.min(F.struct("row_index", "rank", "start")).alias("first"),
        F.max(F.struct("row_index", "rank", "start")).alias("last"),
    ).select(
        "key1", "key2", "file", "n", "rank_dec", "start_dec",
        F.col("bad.row_index").alias("first_bad_row"), F.col("bad.kind").alias("first_bad_kind"),
        F.col("first.row_index").alias("first_row"), F.col("first.rank").alias("first_rank"),
        F.col("first.start").alias("first_start"), F.col("last.row_index").alias("last_row"),
        F.col("last.rank").alias("last_rank"), F.col("last.start").alias("last_start"))


def _violation(rank: F.Column, start: F.Column, before_rank: F.Column, before_start: F.Column
               ) -> F.Column:
    """What falls from one row to the next, or NULL. A NULL start falls never."""
    return F.when(rank < before_rank, F.lit(KIND_RANK)).when(
        (rank == before_rank) & (start < before_start), F.lit(KIND_START))


def file_order(path: str = "file_path") -> list[F.Column]:
    """Sort keys that put part files in their order: by directory, then by the
    part number as a number (names are wider from 100,000 parts on), then by
    name."""
    return [F.regexp_extract(path, "^(.*)/[^/]*$", 1),
            F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1).try_cast("long"), F.col(path)]


def _kind_struct(row: F.Column, kind: F.Column) -> F.Column:
    return F.when(row.isNotNull(), F.struct(row.alias("row"), kind.alias("kind")))


def check_row_order(rows: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """W1 for every table in ``rows`` (columns: group_cols, file_path,
    row_index, seqnames, start; the group columns are constant per file, as
    partition columns are). One output row per table:
    rows_checked, rank_decreases, start_decreases, first_bad_row (1-based),
    first_bad_kind ('rank' | 'start'), first_bad_file, ok."""
    g = list(group_cols or [])
    of_file = Window.partitionBy("key1", "key2")
    segs = (block_summaries(rows, g).withColumn("file", F.max("file").over(of_file))
            .select("*", "file.*").drop("file"))

    # 2. blocks within a file
    w_run = Window.partitionBy("key1", "key2").orderBy("first_row")
    p_rank = F.lag("last_rank").over(w_run)
    p_start = F.lag("last_start").over(w_run)
    segs = segs.withColumn("edge", _violation(F.col("first_rank"), F.col("first_start"),
                                              p_rank, p_start))
    seg_first = F.least(
        _kind_struct(F.col("first_bad_row"), F.col("first_bad_kind")),
        _kind_struct(F.when(F.col("edge").isNotNull(), F.col("first_row")), F.col("edge")))
    files = segs.groupBy("key1", "key2", *g, "file_path").agg(
        F.sum("n").alias("n"),
        (F.sum("rank_dec") + F.count_if(F.col("edge") == KIND_RANK)).alias("rank_dec"),
        (F.sum("start_dec") + F.count_if(F.col("edge") == KIND_START)).alias("start_dec"),
        F.min(seg_first).alias("first_bad"),
        F.min_by("first_rank", "first_row").alias("first_rank"),
        F.min_by("first_start", "first_row").alias("first_start"),
        F.max_by("last_rank", "last_row").alias("last_rank"),
        F.max_by("last_start", "last_row").alias("last_start"),
        F.min("first_row").alias("min_row"),
    )

    # 3. files within a table, with each file's row offset
    w_file = Window.partitionBy(*g).orderBy(*file_order())
    pf_rank = F.lag("last_rank").over(w_file)
    pf_start = F.lag("last_start").over(w_file)
    files = (files
             .withColumn("offset", F.coalesce(
                 F.sum("n").over(w_file.rowsBetween(Window.unboundedPreceding, -1)),
                 F.lit(0).cast("long")))
             .withColumn("edge", _violation(F.col("first_rank"), F.col("first_start"),
                                            pf_rank, pf_start)))
    file_first = F.least(
        F.col("first_bad"),
        _kind_struct(F.when(F.col("edge").isNotNull(), F.col("min_row")), F.col("edge")))
    files = files.withColumn("ff", file_first)
    first = F.min(F.when(
        F.col("ff").isNotNull(),
        F.struct((F.col("offset") + F.col("ff.row") - F.col("min_row") + 1).alias("pos"),
                 F.col("ff.kind").alias("kind"), F.col("file_path").alias("file"))))
    aggs = [
        F.sum("n").alias("rows_checked"),
        (F.sum("rank_dec") + F.count_if(F.col("edge") == KIND_RANK)).alias("rank_decreases"),
        (F.sum("start_dec") + F.count_if(F.col("edge") == KIND_START)).alias("start_decreases"),
        first.alias("first"),
    ]
    out = files.groupBy(*g).agg(*aggs) if g else files.agg(*aggs)
    return out.select(
        *g, "rows_checked", "rank_decreases", "start_decreases",
        F.col("first.pos").alias("first_bad_row"),
        F.col("first.kind").alias("first_bad_kind"),
        F.col("first.file").alias("first_bad_file"),
        F.col("first").isNull().alias("ok"))
