"""User-level jobs (J1-J5, J7, J8): convert coverage files into sorted tables,
query them by region, inspect inputs.

A conversion runs in four steps:

1. list:    the input file list is materialised once (``checkpoint()`` into
            ``spark.checkpoint.dir``), so every later step sees the same files.
2. stage:   index (block pruning, byte-range chunks; decode parallelism sized
            from the chunk bytes) -> decode -> convert -> a staged Parquet table
            under ``spark.checkpoint.dir``; error rows ride along. Staged rows
            carry a file's hash instead of its path; the group columns and the
            constant strand are added back on publishing.
3. gate:    one aggregate over the staged (file, error) columns gives rows per
            file and group, failures and no-data files. Any failure, or a group
            without rows, raises before anything is published (A1-A3); the whole
            lists are Parquet tables next to the output.
4. publish: one shuffle into ranges known from the inputs' indexes + local sort
            + partitioned write aside, then renames (K1, K2).

The staged table is removed afterwards, whether the job succeeded or not.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covtab import paths
from covtab.functions.chrom import order_rank
from covtab.functions.intervals import region_predicate, strand
from covtab.operators.convert import (SAMPLE_LISTED, ConversionError, EmptyResultError,
                                      convert_intervals, failed_files, no_data_files,
                                      rows_per_file)
from covtab.region import RegionSpec, region_root
from covtab.schema import GROUP_COLUMNS, OUTPUT_COLUMNS
from covtab.session import checkpoint_dir, scratch_path
from covtab.sinks.bounds import index_bounds
from covtab.sinks.coverage_parquet import (RANK_COL, read_coverage, table_directory,
                                           write_coverage)
from covtab.sinks.file_index import INDEX_NAME, overlapping, read_index
from covtab.sources.bigwig import (DEFAULT_CHUNK_BYTES, bigwig_chunks, decode_chunks,
                                   decode_partitions)
from covtab.sources.listing import (DiscoveryError, discover_bigwig_dirs, list_bigwig_files,
                                    list_bigwig_paths, require_files)
from covtab.sources.manifest import check_manifest, read_manifest

log = logging.getLogger("covtab")

BROADCAST_FILES = 100_000  # most (file, group) rows that are broadcast, about 10 MB


@dataclass
class ConversionResult:
    """``table`` is the region's root below ``output``; ``groups`` has the rows
    of every group, ``report`` those of every file. ``no_data`` is the path of
    the whole list of files without rows, or None if there are none."""
    output: str
    table: str
    rows_written: int
    files: int
    n_no_data: int
    no_data: str | None
    groups: DataFrame
    report: DataFrame


def _write_report(spark: SparkSession, rows: DataFrame, path: str, n: int) -> str | None:
    """Replace the report table at ``path``; without rows there is none."""
    if n:
        rows.write.mode("overwrite").parquet(path)
        return path
    paths.delete(spark, path)
    return None


def convert_files(spark: SparkSession, files: DataFrame, output: str,
                  region: RegionSpec | None = None, *, group_cols: list[str] = GROUP_COLUMNS,
                  num_partitions: int | None = None, chunk_bytes: int = DEFAULT_CHUNK_BYTES,
                  target_task_bytes: int = 128 << 20, rows_per_output_partition: int = 2_000_000,
                  allow_empty: bool = False, row_group_bytes: int | None = None
                  ) -> ConversionResult:
    """Convert every file of ``files`` (file_path + group columns) into one
    sorted coverage table per group under ``output``. A group that keeps no
    row is an error, or, with ``allow_empty``, an empty table."""
    region = region or RegionSpec()
    output = paths.absolute(output)
    keep = [*group_cols, "file_path"]
    checkpoint_dir(spark)
    # A file that several groups share is decoded once and published for each.
    files = files.select(*keep).distinct().checkpoint(eager=True)
    paths_ = files.select("file_path").distinct().checkpoint(eager=True)
    n_files = paths_.count()
    file_id = F.xxhash64("file_path")
    if paths_.select(file_id).distinct().count() < n_files:
        file_id = F.col("file_path")  # two paths share a hash
    staged_path = scratch_path(spark, "staged")
    # index stage once (tiny rows), then decode with a task count sized from the
    # compressed bytes to read
    chunks = bigwig_chunks(paths_, region, chunk_bytes, num_partitions).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        raw = decode_chunks(chunks, num_partitions or decode_partitions(chunks, target_task_bytes))
        rows = convert_intervals(raw.drop(*GROUP_COLUMNS), region, keep_file_path=True)
        (rows.select(file_id.alias("file_id"), *[c for c in OUTPUT_COLUMNS if c != "strand"],
                     "error").write.parquet(staged_path))
        staged = spark.read.parquet(staged_path)

        # A1-A3: rows and errors of each file, from two narrow staged columns
        named_files = files.withColumn("file_id", file_id)
        by_id = rows_per_file(named_files.select("file_id").distinct(),
                              staged.select("file_id", "error"))
        per_file = (named_files.join(by_id, "file_id")
                    .select(*keep, "rows_written", "error").checkpoint(eager=True))
        failed = failed_files(per_file)
        n_failed = failed.count()
        report = _write_report(spark, failed, f"{output}.failures", n_failed)
        if n_failed:
            sample = [(r["file_path"], r["error"]) for r in failed.limit(SAMPLE_LISTED).collect()]
            raise ConversionError(n_failed, report, sample)
        empty = no_data_files(per_file)
        n_empty = empty.count()
        no_data = _write_report(spark, empty.orderBy("file_path"), f"{output}.no-data", n_empty)
        if n_empty:
            log.warning("%d input file(s) kept no interval; they are listed in %s",
                        n_empty, no_data)
        totals = (per_file.groupBy(*group_cols) if group_cols else per_file.groupBy()).agg(
            F.sum("rows_written").alias("rows_written"))
        totals = totals.checkpoint(eager=True)
        bare = totals.filter(F.coalesce("rows_written", F.lit(0)) == 0)
        n_bare = bare.count()
        if n_bare and not allow_empty:
            shown = ["/".join(map(str, r[:-1])) or "the input" for r in
                     bare.orderBy(*(group_cols or ["rows_written"])).limit(SAMPLE_LISTED).collect()]
            raise EmptyResultError(f"{n_bare} group(s) kept no interval, so nothing was "
                                   f"published; the first {len(shown)}: {', '.join(shown)}")
        total = int(totals.agg(F.sum("rows_written")).first()[0] or 0)
        # publish parallelism sized by rows, whatever the cluster
        n_out = num_partitions or max(1, -(-total // max(1, rows_per_output_partition)))
        rows = staged.drop("error").withColumn("strand", strand())
        if group_cols:
            groups = named_files.drop("file_path")
            rows = rows.join(F.broadcast(groups) if files.count() <= BROADCAST_FILES
                             else groups, "file_id")
        write_coverage(rows.select(*group_cols, *OUTPUT_COLUMNS), output, region, n_out,
                       group_cols, row_group_bytes=row_group_bytes,
                       bounds=index_bounds(chunks, files, group_cols) if n_out > 1 else None,
                       empty=bare if n_bare else None)
        return ConversionResult(output, region_root(output, region), total, n_files, n_empty,
                                no_data, totals, per_file.drop("error"))
    finally:
        chunks.unpersist()
        paths.delete(spark, staged_path)


def convert_directory(spark: SparkSession, input_dir: str, output: str,
                      region: RegionSpec | None = None, **kw) -> ConversionResult:
    """Every '*.bw'/'*.bigwig' file of one directory -> one sorted table."""
    checkpoint_dir(spark)
    files = list_bigwig_paths(spark, input_dir).checkpoint(eager=True)
    if files.isEmpty():
        raise DiscoveryError(f"{input_dir} holds no coverage file")
    return convert_files(spark, files, output, region, group_cols=[], **kw)


def convert_manifest(spark: SparkSession, manifest: DataFrame | str, output: str,
                     region: RegionSpec | None = None, **kw) -> ConversionResult:
    """Every manifest row (study, group, directory) in ONE job; the
    output holds one table per (study, group)."""
    if isinstance(manifest, str):
        manifest = read_manifest(spark, manifest)
    checkpoint_dir(spark)
    manifest = manifest.checkpoint(eager=True)
    check_manifest(manifest)
    files = list_bigwig_files(manifest).checkpoint(eager=True)
    require_files(manifest, files)
    return convert_files(spark, files, output, region, **kw)


def convert_study(spark: SparkSession, input_base: str, study: str, output: str,
                  region: RegionSpec | None = None, **kw) -> ConversionResult:
    """Every '<input_base>/<study>/<group>/bigwig' directory of one study."""
    checkpoint_dir(spark)
    dirs = discover_bigwig_dirs(spark, input_base, study=study).checkpoint(eager=True)
    if dirs.isEmpty():
        raise DiscoveryError(f"study {study} has no bigwig directory below {input_base}")
    return convert_manifest(spark, dirs, output, region, **kw)


def region_query(spark: SparkSession, output: str, region: RegionSpec,
                 study: str | None = None, group: str | None = None,
                 published: RegionSpec | None = None) -> DataFrame:
    """Rows of a published dataset in a region; ``published`` names the
    conversion to read (the autosomes by default). The (study, group) and
    chromosome filters prune directories, so only files of the wanted
    chromosomes are opened; start/end filters reach the Parquet reader and skip
    row groups by their min/max (the files are sorted)."""
    root = region_root(paths.absolute(output), published or RegionSpec())
    ranks = [int(x) for x in spark.range(1).select(
        *[order_rank(F.lit(c)) for c in region.allowed_chroms]).first()]
    files = None
    if region.pos_start is not None or region.pos_end is not None:
        files = _files_of_region(spark, root, region, ranks, study, group)
    df = read_coverage(spark, root, keep_rank=True, files=files)
    if study is not None:
        df = df.filter(F.col("study_name") == study)
    if group is not None:
        df = df.filter(F.col("qtl_group") == group)
    df = df.filter(F.col(RANK_COL).cast("int").isin(ranks))
    return df.filter(region_predicate(region)).drop(RANK_COL)


def _files_of_region(spark: SparkSession, root: str, region: RegionSpec, ranks: list[int],
                     study: str | None, group: str | None) -> list[str] | None:
    """Files that the tables' indexes leave for a region, as paths from
    ``root``; None where some table has no index. A region with bounds has few
    in each table."""
    grouped = any("=" in x and not x.startswith(RANK_COL) for x in paths.children(spark, root))
    below = f"/{table_directory(study, group)}" if grouped else ""
    tables = paths.matching(spark, paths.glob_safe(root) + below)
    indexed = paths.matching(spark, f"{paths.glob_safe(root)}{below}/{INDEX_NAME}")
    if not tables or len(indexed) < len(tables):
        return None
    found = overlapping(read_index(spark, tables), ranks, region.pos_start, region.pos_end)
    return [r["file"] for r in found.select("file").toLocalIterator()]


# ------------------------------------------------------------ inspection jobs

def inspect_directory(spark: SparkSession, path: str, recursive: bool = False):
    """Readability of every coverage file under ``path`` (A4) and the
    per-directory summary with the list of unreadable files (A5).
    Returns (per_file, summary, bad)."""
    from covtab.operators.inspect import directory_summary
    from covtab.sources.bigwig import readability

    # listed once: every later step sees the same files
    checkpoint_dir(spark)
    files = list_bigwig_paths(spark, path, recursive).checkpoint(eager=True)
    if files.isEmpty():
        raise DiscoveryError(f"{path} holds no coverage file")
    per_file = readability(files).drop(*GROUP_COLUMNS).join(
        files.select("file_path", "bigwig_dir"), "file_path").checkpoint(eager=True)
    summary, bad = directory_summary(per_file)
    return per_file, summary, bad


def inspect_files(spark: SparkSession, path: str, chrom: str | None = None, start: int = 0,
                  end: int | None = None, n: int = 10, recursive: bool = False):
    """J5 for one file or every file of a directory: overview (size, number
    of chromosomes), the first 10 chromosomes (P8 order), the first ``n``
    intervals of the first chromosome with data in [start, end) — or of
    ``chrom`` — and what failed: files that cannot be read, that lack
    ``chrom`` or hold no interval there. Returns (overview, first_chroms, head,
    failures)."""
    from covtab.operators.inspect import check_inspect_args, file_overview, first_chromosomes
    from covtab.sources.bigwig import bigwig_head, chrom_sizes

    check_inspect_args(start, end, n)
    checkpoint_dir(spark)
    files = list_bigwig_paths(spark, path, recursive).checkpoint(eager=True)
    sizes = chrom_sizes(files).checkpoint(eager=True)
    good = sizes.filter(F.col("error").isNull())
    head = bigwig_head(files, start, end, n, chrom, sizes=sizes).checkpoint(eager=True)
    failures = head.filter(F.col("error").isNotNull()).select("file_path", "error")
    return (file_overview(files, sizes), first_chromosomes(good, 10),
            head.filter(F.col("error").isNull()).drop("error"), failures)


def null_report(spark: SparkSession, path: str, n: int = 5):
    """J7 on a published dataset: per-column NA counts (A15) and the first
    ``n`` rows with an NA in physical order (O8). Returns (counts, rows)."""
    from covtab.operators.inspect import na_rows
    from covtab.operators.order_check import file_order
    from covtab.operators.validate import na_report, physical_rows

    path = paths.absolute(path)
    if not paths.exists(spark, path):
        raise FileNotFoundError(f"no such table: {path}")
    df = physical_rows(spark, path)
    g = [c for c in GROUP_COLUMNS if c in df.columns]
    return na_report(df, g), na_rows(df, g, n, order_cols=[*file_order(), "row_index"])
