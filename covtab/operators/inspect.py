"""Input inspection and table reports (J4, J5, J7; A5, O5-O8).

All operate on many files/tables at once. Per-group top-n uses
``row_number() <= n`` over (file[, chrom]) windows; Spark plans these with a
partial WindowGroupLimit before the shuffle, so a file holding a third of all
rows ships only n rows per task, never the whole file to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covtab.functions.chrom import inspect_rank
from covtab.schema import GROUP_COLUMNS, OUTPUT_COLUMNS
from covtab.session import checkpoint_dir


def directory_summary(readable: DataFrame, dir_col: str = "bigwig_dir") -> tuple[DataFrame, DataFrame]:
    """A5 from A4 rows (file_path, ok, message[, dir]): per directory the
    total / readable / unreadable counts, and the BAD list with each file's
    1-based position in path order."""
    df = readable
    if dir_col not in df.columns:
        df = df.withColumn(dir_col, F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1))
    summary = df.groupBy(dir_col).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if("ok").alias("readable"),
        F.count_if(~F.col("ok")).alias("unreadable"))
    place = positions(df.select(dir_col, "file_path"), dir_col)
    bad = (df.filter(~F.col("ok")).select(dir_col, "file_path", "message")
             .join(place, [dir_col, "file_path"])
             .select(dir_col, "position", "file_path",
                     F.substring_index("file_path", "/", -1).alias("file_name"), "message"))
    return summary, bad


def positions(files: DataFrame, dir_col: str) -> DataFrame:
    """``files`` with each one's 1-based position in its directory, in path
    order component by component. The files are dealt in ranges of names, so a
    directory with most of them is numbered by many tasks: within a range by
    counting, across ranges by the numbers of files in the ranges before."""
    checkpoint_dir(files.sparkSession)
    parts = F.split("file_path", "/")
    dealt = (files.repartitionByRange(F.col(dir_col), parts)
             .withColumn("range", F.spark_partition_id()).checkpoint(eager=True))
    sizes = dealt.groupBy(dir_col, "range").agg(F.count("*").alias("size"))
    before = Window.partitionBy(dir_col).orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select(dir_col, "range", F.coalesce(F.sum("size").over(before), F.lit(0))
                           .alias("offset"))
    local = F.row_number().over(Window.partitionBy(dir_col, "range").orderBy(parts))
    return (dealt.withColumn("local", local).join(offsets, [dir_col, "range"])
            .select(dir_col, "file_path", (F.col("offset") + F.col("local")).cast("int")
                    .alias("position")))


def check_inspect_args(start: int, end: int | None, n: int) -> None:
    """V3: start >= 0, end > start, n >= 1."""
    if start < 0:
        raise ValueError(f"the first position is {start}, below 0")
    if end is not None and end <= start:
        raise ValueError(f"no position lies from {start} up to {end}")
    if n < 1:
        raise ValueError(f"{n} intervals are no head; ask for 1 or more")


def first_chromosomes(sizes: DataFrame, n: int = 10) -> DataFrame:
    """Per file, the first ``n`` chromosomes by (P8 rank, name), with
    their sizes. ``sizes``: file_path, chrom, size."""
    w = Window.partitionBy("file_path").orderBy(inspect_rank("chrom"), "chrom")
    return (sizes.select("file_path", "chrom", "size")
                 .withColumn("rn", F.row_number().over(w))
                 .filter(F.col("rn") <= n))


def head_intervals(raw: DataFrame, n: int = 10) -> DataFrame:
    """Per (file, chromosome), the first ``n`` raw intervals by start
    (then end, score, for a total order)."""
    check_inspect_args(0, None, n)
    w = Window.partitionBy("file_path", "chrom").orderBy("start0", "end0", "score")
    return (raw.select("file_path", "chrom", "start0", "end0", "score")
               .withColumn("rn", F.row_number().over(w))
               .filter(F.col("rn") <= n))


def first_chrom_head(raw: DataFrame, sizes: DataFrame, start: int = 0, end: int | None = None,
                     n: int = 10, chrom: str | None = None) -> DataFrame:
    """O7 + O6: per file, the first chromosome (P8 order; or the requested
    one, exact name first, then without 'chr') having an interval that
    overlaps [start, min(end, size)), and its first ``n`` such intervals.
    A chromosome shorter than ``start`` is skipped, not an error."""
    check_inspect_args(start, end, n)
    s = sizes.select("file_path", "chrom", "size")
    q_end = F.col("size") if end is None else F.least(F.lit(end).cast("long"), F.col("size"))
    s = s.withColumn("q_end", q_end).filter(F.lit(start) < F.col("q_end"))
    if chrom is not None:
        pref = (F.when(F.col("chrom") == chrom, 0)
                 .when(F.replace(F.col("chrom"), F.lit("chr"), F.lit("")) == chrom.replace("chr", ""), 1))
        s = s.withColumn("pref", pref).filter(F.col("pref").isNotNull())
    else:
        s = s.withColumn("pref", F.lit(0))
    hits = (raw.select("file_path", "chrom", "start0", "end0", "score")
               .join(s.select("file_path", "chrom", "q_end", "pref"), ["file_path", "chrom"])
               .filter((F.col("start0") < F.col("q_end")) & (F.col("end0") > F.lit(start))))
    # One pass over the hits: the first n of EVERY (file, chrom) — limited
    # per task before the shuffle — then, among those few rows, keep the
    # file's first chromosome. Every chromosome with a hit survives step one,
    # so the choice is the same as over all hits.
    w_chrom = Window.partitionBy("file_path", "chrom").orderBy("start0", "end0", "score")
    heads = (hits.withColumn("rn", F.row_number().over(w_chrom))
                 .filter(F.col("rn") <= n)
                 .withColumn("key", F.struct("pref", inspect_rank("chrom").alias("rank"), "chrom")))
    w_file = Window.partitionBy("file_path")
    return (heads.withColumn("first_key", F.min("key").over(w_file))
                 .filter(F.col("key") == F.col("first_key"))
                 .select("file_path", "chrom", "start0", "end0", "score", "rn"))


def file_overview(files: DataFrame, sizes: DataFrame) -> DataFrame:
    """J5 summary: per file its size in bytes (S13) and chromosome count."""
    counts = sizes.filter(F.col("error").isNull()).groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n_chroms"))
    errors = sizes.filter(F.col("error").isNotNull()).select("file_path", "error")
    return (files.select("file_path", "size")
                 .join(counts, "file_path", "left")
                 .join(errors, "file_path", "left")
                 .withColumn("n_chroms", F.coalesce("n_chroms", F.lit(0).cast("long"))))


def na_rows(df: DataFrame, group_cols: list[str] = GROUP_COLUMNS, n: int = 5,
            order_cols: list | None = None) -> DataFrame:
    """Per table, the first ``n`` rows with a NULL (or NaN score), in
    ``order_cols`` order (physical order when file_path/row_index are given)."""
    types = dict(df.dtypes)
    cond = None
    for c in OUTPUT_COLUMNS:
        e = F.col(c).isNull()
        if types.get(c) in ("double", "float"):
            e = e | F.isnan(c)
        cond = e if cond is None else cond | e
    order = order_cols or ["seqnames", "start", "end", "sample_id", "strand", "score"]
    if not group_cols:
        return df.filter(cond).orderBy(*order).limit(n)   # distributed top-k
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return (df.filter(cond).withColumn("rn", F.row_number().over(w))
              .filter(F.col("rn") <= n))
