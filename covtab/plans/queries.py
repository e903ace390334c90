"""Registered queries: each operator run over the driver tables.

Every query reads whole tables (no row caps or id subsets) through the
fixture projections of ``covtab.sources.fixture`` and returns a lazy
DataFrame. Column names equal those of the matching SQL in
``covtab.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from covtab import paths
from covtab.functions.intervals import nan_to_null, sample_id_from_path
from covtab.operators.convert import (ConversionError, convert_intervals, no_data_files,
                                      rows_per_file)
from covtab.operators.inspect import (directory_summary, first_chrom_head, first_chromosomes,
                                      head_intervals, na_rows)
from covtab.operators.order_check import check_row_order
from covtab.operators.validate import chrom_counts, integrity_counts, na_report, validate_dataset
from covtab.plans.jobs import (convert_directory, convert_manifest, convert_study,
                               inspect_directory, null_report, region_query)
from covtab.region import Expectation, RegionSpec
from covtab.schema import GROUP_COLUMNS, OUTPUT_COLUMNS
from covtab.session import scratch_path, ship_package
from covtab.sinks.coverage_parquet import (read_coverage, register_table, sorted_for_publish,
                                           write_coverage)
from covtab.sources.bigwig import (bigwig_head, chrom_sizes, readability, scan_bigwig,
                                   scan_bigwig_range, without_errors)
from covtab.sources.bigwig_datasource import register_bigwig_source
from covtab.sources.fixture import (add_broken_files, customer_dirs, customer_manifest,
                                   damage_files, encode_bigwigs, encode_lineitem_bigwigs,
                                   lineitem_intervals, mixed_name_intervals, orders_row_sequence,
                                   touch_files, write_customer_files)
from covtab.sources.listing import (bigwig_dirs_from_paths, discover_bigwig_dirs,
                                   list_bigwig_files)
from covtab.sources.manifest import planned_outputs, read_manifest, write_manifest
from covtab.streaming.incremental import (convert_pending, pending_groups, published_groups,
                                         read_done, read_rejected, start_manifest_stream)

# Fixed parameters of the registered queries.
REGION_22 = RegionSpec("22", 20000, 60000)
REGION_X = RegionSpec("X")
REGION_22_TO_3000 = RegionSpec("22", None, 3000)
REGION_AMONG_LONG = RegionSpec("1", 100_000, 100_500)


# --- conversion

def q_convert_autosomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_intervals(lineitem_intervals(spark, sf_dir))


def q_convert_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_intervals(lineitem_intervals(spark, sf_dir), REGION_22)


def q_convert_chrom_x(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_intervals(lineitem_intervals(spark, sf_dir), REGION_X)


def q_sorted_autosomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: autosome conversion in published order (K1 plan without
    the write)."""
    return sorted_for_publish(q_convert_autosomes(spark, sf_dir))


def _per_file(spark: SparkSession, sf_dir: str, region: RegionSpec | None = None) -> DataFrame:
    raw = lineitem_intervals(spark, sf_dir)
    keys = ["study_name", "qtl_group", "file_path"]
    return rows_per_file(raw.select(*keys).distinct(),
                         convert_intervals(raw, region, keep_file_path=True))


def q_rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: rows kept per input file, zero included."""
    return _per_file(spark, sf_dir)


def q_no_data_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: files keeping no row for chr22 up to 3,000."""
    return no_data_files(_per_file(spark, sf_dir, REGION_22_TO_3000))


# --- validation

def q_chrom_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chrom_counts(q_convert_autosomes(spark, sf_dir))


def q_validate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6-A14 over every (study, group) table of the autosome conversion,
    checked against chromosome 22, 20,000-60,000 so the counts are not all 0."""
    return integrity_counts(q_convert_autosomes(spark, sf_dir), Expectation.of(REGION_22))


def q_null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return na_report(q_convert_autosomes(spark, sf_dir))


def q_na_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 5 rows with an NA of every converted table."""
    return na_rows(q_convert_autosomes(spark, sf_dir))


def q_row_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 on the orders row sequence (o_orderkey = physical row index)."""
    return check_row_order(orders_row_sequence(spark, sf_dir))


# --- discovery and planned outputs

def q_discover_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1/P9/F6 on candidate directories, one per customer."""
    return bigwig_dirs_from_paths(customer_dirs(spark, sf_dir, "/cov"), "/cov")


def q_output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned output of every manifest row (one per customer) for
    chr22:20,000-60,000."""
    return planned_outputs(customer_manifest(spark, sf_dir, "/cov"), "/out", REGION_22)


# --- inspection

def _fixture_sizes(raw: DataFrame) -> DataFrame:
    """D3 for the fixture: a chromosome's size is its largest end."""
    return raw.groupBy("file_path", "chrom").agg(F.max("end0").cast("long").alias("size"))


def q_chrom_sort_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 10 chromosomes of every file."""
    return first_chromosomes(_fixture_sizes(lineitem_intervals(spark, sf_dir)), 10)


def q_head_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 10 raw intervals of every (file, chromosome)."""
    return head_intervals(lineitem_intervals(spark, sf_dir), 10)


def q_first_chrom_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O7+O6: per file, the first chromosome with data from 1,000,000 on,
    and its first 10 intervals there."""
    raw = lineitem_intervals(spark, sf_dir)
    return first_chrom_head(raw, _fixture_sizes(raw), start=1_000_000, n=10)


# --- written tables (K1, K2, J8, J6 end to end)

def q_sorted_write_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1+J8: publish the autosome tables (range shuffle, sort, partitioned
    write under the shared checkpoint folder), then read chr22:20,000-60,000
    back with directory and row-group pruning."""
    out = scratch_path(spark, "published")
    write_coverage(q_convert_autosomes(spark, sf_dir), out)
    return region_query(spark, out, REGION_22).select(
        "study_name", "qtl_group", *OUTPUT_COLUMNS)


def q_validate_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 end to end: publish the autosome tables, then validate the written
    files (schema, one aggregate chain, physical row order) against
    chromosome 22, 20,000-60,000."""
    out = scratch_path(spark, "validated")
    root = write_coverage(q_convert_autosomes(spark, sf_dir), out)
    return validate_dataset(spark, root, Expectation.of(REGION_22))


# --- real BigWig bytes

def _encode(spark: SparkSession, sf_dir: str) -> str:
    """lineitem written as BigWig files in the shared scratch folder; returns
    the tree's root."""
    root = scratch_path(spark, "bigwig")
    encode_lineitem_bigwigs(spark, sf_dir, root).agg(F.sum("rows")).collect()
    return f"{root}/cov"


def _encoded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded files, discovered and listed like real input."""
    dirs = discover_bigwig_dirs(spark, _encode(spark, sf_dir)).checkpoint(eager=True)
    return list_bigwig_files(dirs).checkpoint(eager=True)


def _original():
    """The sample file that an encoded part stems from."""
    return F.regexp_replace(F.substring_index("file_path", "/", -1), r"\.t[0-9-]{11}\.", ".")


def _sample_file():
    """The same, also of a part that ``add_broken_files`` replaced."""
    return F.regexp_replace(_original(), r"\.missing$", "")


def q_bigwig_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1/S4/S6 + conversion through real BigWig bytes: the autosome table
    decoded from files (scores pass through float32, as BigWig stores them).
    A file that cannot be read fails the query."""
    return convert_intervals(without_errors(scan_bigwig(_encoded_files(spark, sf_dir))))


def q_bigwig_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw intervals of chr22 overlapping [20,000, 60,000) from the BigWig
    files that list the chromosome ('chr22' where a file has it, else '22');
    files without it give an error row each, which is left out here."""
    r = scan_bigwig_range(_encoded_files(spark, sf_dir), "chr22", 20000, 60000)
    lacks = F.coalesce(F.col("error") == "has no chromosome chr22", F.lit(False))
    r = without_errors(r.filter(~lacks))
    return r.select("study_name", "qtl_group", sample_id_from_path("file_path").alias("sample_id"),
                    "chrom", "start0", "end0", "score")


def q_bigwig_chrom_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + A4 over the BigWig files: per original sample file, the number of
    distinct chromosomes in its chromosome trees (across the parts written by
    different tasks) and whether every part opens."""
    files = _encoded_files(spark, sf_dir)
    keys = ["study_name", "qtl_group", "file_name"]
    chroms = (without_errors(chrom_sizes(files))
              .select("study_name", "qtl_group", _original().alias("file_name"), "chrom")
              .groupBy(*keys).agg(F.count_distinct("chrom").alias("n_chroms")))
    opened = (readability(files)
              .groupBy("study_name", "qtl_group", _original().alias("file_name"))
              .agg(F.bool_and("ok").alias("all_readable")))
    return opened.join(chroms, keys, "left").select(
        *keys, F.coalesce("n_chroms", F.lit(0).cast("long")).alias("n_chroms"), "all_readable")


def q_file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Original sample files found by the listing, and whether every
    part has a size and a time of change."""
    return (_encoded_files(spark, sf_dir)
            .groupBy("study_name", "qtl_group", _original().alias("file_name"))
            .agg(F.bool_and((F.col("size") > 0) & (F.col("modified") > 0)).alias("has_size")))


def q_unreadable_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4/A5 with the files of some samples missing: each directory's sample
    files, which of them the list of bad ones names, and whether the summary
    counts what was listed."""
    root = _encode(spark, sf_dir)
    dirs = discover_bigwig_dirs(spark, root).checkpoint(eager=True)
    files = add_broken_files(list_bigwig_files(dirs)).checkpoint(eager=True)
    summary, bad = directory_summary(readability(files))
    sample = _sample_file()
    listed = bad.groupBy("bigwig_dir").agg(
        F.count("*").alias("listed"), F.count_distinct(sample).alias("named"),
        F.array_join(F.array_sort(F.collect_set(sample)), ",").alias("names"))
    expected = files.groupBy("bigwig_dir").agg(
        F.count("*").alias("files"), F.count_distinct(sample).alias("sample_files"))
    none = F.lit(0).cast("long")
    return (summary.join(listed, "bigwig_dir", "left").join(expected, "bigwig_dir")
            .select(F.regexp_extract("bigwig_dir", "/cov/([^/]+)/", 1).alias("study_name"),
                    F.regexp_extract("bigwig_dir", "/([^/]+)/bigwig$", 1).alias("qtl_group"),
                    "sample_files", F.coalesce("named", none).alias("unreadable_files"),
                    F.coalesce("names", F.lit("")).alias("unreadable_names"),
                    ((F.col("total_files") == F.col("files"))
                     & (F.col("unreadable") == F.coalesce("listed", none))
                     & (F.col("readable") == F.col("files") - F.col("unreadable")))
                    .alias("counts_agree")))


def q_conversion_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the gate's report when the files of some samples are missing: per
    sample file, how many of its parts failed and how many rows it gave."""
    files = add_broken_files(_encoded_files(spark, sf_dir)).checkpoint(eager=True)
    converted = convert_intervals(scan_bigwig(files), keep_file_path=True)
    keys = ["study_name", "qtl_group", "file_path"]
    report = rows_per_file(files.select(*keys), converted)
    failed = F.col("error").isNotNull()
    return report.groupBy("study_name", "qtl_group", _sample_file().alias("file_name")).agg(
        F.when(F.bool_and(failed), "all").when(F.bool_or(failed), "some").otherwise("none")
        .alias("parts_failed"), F.sum("rows_written").alias("rows_written"))


def q_inspect_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5/O6/O7 on real files: chromosome 22 ('chr22' or '22') from 1,000,000
    on; per original sample file, the first interval over its parts that hold
    one. Parts without such an interval report it instead of rows."""
    head = bigwig_head(_encoded_files(spark, sf_dir), start=1_000_000, n=1, chrom="22")
    quiet = F.coalesce(F.col("error").isin("has no chromosome 22", "no interval in the range"),
                       F.lit(False))
    head = without_errors(head.filter(~quiet))
    dirs = F.regexp_extract("file_path", "/cov/(.*)/[^/]*$", 1)
    return (head.groupBy(dirs.alias("directory"), _original().alias("file_name"), "chrom")
            .agg(F.min(F.struct("start0", "end0")).alias("first"))
            .select("directory", "file_name", "chrom", "first.start0", "first.end0"))


# --- the conversion jobs end to end

def _convert_all(spark: SparkSession, sf_dir: str, **kw):
    """Discovered directories -> written and re-read manifest -> tables."""
    root = _encode(spark, sf_dir)
    manifest = scratch_path(spark, "manifest")
    write_manifest(discover_bigwig_dirs(spark, root), manifest)
    out = scratch_path(spark, "converted")
    return convert_manifest(spark, read_manifest(spark, manifest), out, **kw)


def q_convert_manifest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The autosome tables as published."""
    return read_coverage(spark, _convert_all(spark, sf_dir).table).select(
        "study_name", "qtl_group", *OUTPUT_COLUMNS)


def q_job_rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/A2 from the job's own gate, summed over a sample file's parts."""
    report = _convert_all(spark, sf_dir).report
    return report.groupBy("study_name", "qtl_group", _original().alias("file_name")).agg(
        F.sum("rows_written").alias("rows_written"))


def q_convert_study_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """study_1's tables for chromosome 22, 20,000-60,000."""
    out = scratch_path(spark, "study")
    result = convert_study(spark, _encode(spark, sf_dir), "study_1", out, REGION_22,
                           allow_empty=True)
    return read_coverage(spark, result.table).select("study_name", "qtl_group", *OUTPUT_COLUMNS)


def q_convert_directory_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One directory's table, read through a temporary view."""
    root = _encode(spark, sf_dir)
    result = convert_directory(spark, f"{root}/study_0/grp_1/bigwig",
                               scratch_path(spark, "directory"))
    register_table(spark, result.table, "one_directory")
    return spark.sql("SELECT seqnames, start, end, strand, score, sample_id FROM one_directory")


def q_region_tables_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the autosomes, then chromosome 22, then the autosomes again, to one
    output: both tables stay whole."""
    out = scratch_path(spark, "regions")
    conv = q_convert_autosomes(spark, sf_dir)
    for region in (RegionSpec(), RegionSpec("22"), RegionSpec()):
        part = conv if region.chrom is None else convert_intervals(
            lineitem_intervals(spark, sf_dir), region)
        write_coverage(part, out, region)
    tables = [read_coverage(spark, f"{out}/region={r.label}").withColumn("region", F.lit(r.label))
              for r in (RegionSpec(), RegionSpec("22"))]
    return tables[0].unionByName(tables[1]).groupBy("region", "study_name", "qtl_group").agg(
        F.count("*").alias("n"))


def q_republish_fewer_chromosomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1/K2: grp_0's tables are published again with chromosomes 1 to 11 only:
    their other chromosomes are gone, grp_1's tables keep all of theirs. Rows,
    least start and greatest end of each table and chromosome."""
    out = scratch_path(spark, "republished")
    conv = q_convert_autosomes(spark, sf_dir)
    write_coverage(conv, out)
    fewer = conv.filter((F.col("qtl_group") == "grp_0") & (F.col("seqnames").cast("int") <= 11))
    root = write_coverage(fewer, out)
    return read_coverage(spark, root).groupBy("study_name", "qtl_group", "seqnames").agg(
        F.count("*").alias("n"), F.min("start").alias("first_start"),
        F.max("end").alias("last_end"))


def q_region_among_long_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 with some intervals of 50,000 positions, in tables of several files a
    chromosome: the file indexes leave those that overlap chromosome 1 from
    100,000 to 100,500."""
    raw = lineitem_intervals(spark, sf_dir)
    long = F.pmod(F.col("start0"), F.lit(11)) == 0
    raw = raw.withColumn("end0", F.when(long, F.col("start0") + 50_000).otherwise(F.col("end0")))
    out = scratch_path(spark, "long")
    write_coverage(convert_intervals(raw), out, num_partitions=64)
    return region_query(spark, out, REGION_AMONG_LONG, published=RegionSpec()).select(
        "study_name", "qtl_group", *OUTPUT_COLUMNS)


def q_incremental_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """study_0 is converted first; of all groups, which are then pending,
    and which have a table."""
    root = _encode(spark, sf_dir)
    out, done = scratch_path(spark, "incremental"), scratch_path(spark, "done")
    dirs = discover_bigwig_dirs(spark, root).checkpoint(eager=True)
    convert_pending(spark, dirs.filter("study_name = 'study_0'"), out, done)
    pending = pending_groups(dirs, list_bigwig_files(dirs), read_done(spark, done), out)
    keys = ["study_name", "qtl_group"]
    return (dirs.select(*keys)
            .join(pending.select(*keys, F.lit(True).alias("pending")), keys, "left")
            .join(published_groups(dirs, out).withColumn("published", F.lit(True)), keys, "left")
            .select(*keys, F.coalesce("pending", F.lit(False)).alias("pending"),
                    F.coalesce("published", F.lit(False)).alias("published")))


def q_na_rows_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7/O8/S11 on written tables: the first 5 rows with an NA of each table in
    physical order, with their position among those rows."""
    out = scratch_path(spark, "na")
    root = write_coverage(q_convert_autosomes(spark, sf_dir), out)
    _, rows = null_report(spark, root, 5)
    return rows.select("study_name", "qtl_group", *OUTPUT_COLUMNS, "rn")


def q_ordered_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the place of each directory in its study, in the order in which
    discovery returns its rows."""
    listed = q_discover_dirs(spark, sf_dir).withColumn("row", F.monotonically_increasing_id())
    w = Window.partitionBy("study_name").orderBy("row")
    return listed.withColumn("place", F.row_number().over(w)).drop("row")


# --- what goes wrong, and what stays whole

def q_damaged_files_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3/O4 through J2: of three samples in each study the files are cut in
    their index, spoilt in a block, or reach beyond 32-bit positions. The job
    publishes nothing; its report, read back in order, names the sample files
    and how each part failed."""
    root = _encode(spark, sf_dir)
    dirs = discover_bigwig_dirs(spark, root).checkpoint(eager=True)
    damage_files(list_bigwig_files(dirs).checkpoint(eager=True)).count()
    out = scratch_path(spark, "damaged")
    try:
        convert_manifest(spark, dirs, out)
        report = f"{out}.failures"  # there is none: reading it fails the query
    except ConversionError as e:
        report = e.report
    kind = (F.when(F.col("error").contains("int32"), "range")
            .when(F.col("error").startswith("chunk "), "block").otherwise("index"))
    listed = spark.read.parquet(report).select(
        F.regexp_extract("file_path", "/cov/([^/]+)/", 1).alias("study_name"),
        F.regexp_extract("file_path", "/cov/[^/]+/([^/]+)/", 1).alias("qtl_group"),
        _original().alias("file_name"), kind.alias("kind"),
        F.struct(F.col("_metadata.file_name"), F.col("_metadata.row_index")).alias("at"))
    first = listed.groupBy("study_name", "qtl_group", "file_name").agg(
        F.min("at").alias("at"), F.max("kind").alias("kind"),
        F.lit(paths.exists(spark, out)).alias("published"))
    # a handful of damaged sample files a study
    return first.select("study_name", "qtl_group", "file_name", "kind", "published",
                        F.row_number().over(Window.orderBy("at")).alias("place"))


def q_validate_with_a_bad_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file of study_1/grp_0 has two columns swapped. That table has a
    FAIL for the file and SKIPs, the five others their whole reports."""
    root = write_coverage(q_convert_autosomes(spark, sf_dir), scratch_path(spark, "one-bad"))
    swapped = scratch_path(spark, "swapped")
    table = "study_name=study_1/qtl_group=grp_0/chrom_rank=0001"
    (spark.read.parquet(f"{root}/{table}").select("start", "seqnames", "end", "strand", "score",
                                                  "sample_id").coalesce(1).write.parquet(swapped))
    file, = (x for x in paths.children(spark, swapped) if x.endswith(".parquet"))
    paths.rename(spark, f"{swapped}/{file}", f"{root}/{table}/part-00000-swapped.parquet")
    report = validate_dataset(spark, root, Expectation.of(REGION_22))
    named = F.regexp_replace("detail", "^.*/([^/]*parquet): ", "$1: ")
    return report.withColumn("detail", named)


def q_mixed_names_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that hold both 'chr1' and '1'. Conversion unites them and
    keeps duplicates; a range of 'chr1', and one of '1', sees that name alone."""
    root = scratch_path(spark, "mixed")
    encode_bigwigs(mixed_name_intervals(spark, sf_dir), root).agg(F.sum("rows")).collect()
    dirs = discover_bigwig_dirs(spark, f"{root}/cov").checkpoint(eager=True)
    files = list_bigwig_files(dirs).checkpoint(eager=True)
    united = convert_intervals(without_errors(scan_bigwig(files))).select(
        F.lit("converted").alias("view"), *GROUP_COLUMNS, "sample_id", "seqnames",
        F.col("start").cast("long").alias("first"), F.col("end").cast("long").alias("last"), "score")

    def ranged(name: str) -> DataFrame:
        return without_errors(scan_bigwig_range(files, name, 100_000, 200_000)).select(
            F.lit(f"range of {name}").alias("view"), *GROUP_COLUMNS,
            sample_id_from_path("file_path").alias("sample_id"), F.col("chrom").alias("seqnames"),
            F.col("start0").alias("first"), F.col("end0").alias("last"),
            nan_to_null("score").alias("score"))
    return united.unionByName(ranged("chr1")).unionByName(ranged("1"))


def q_inspect_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4/S5/O3/A4/A5 on a nested tree, a file for each customer and a fifth of
    them in one directory: the unreadable files with their positions in path
    order, beside the totals of the tree."""
    root = scratch_path(spark, "tree")
    write_customer_files(spark, sf_dir, root).count()
    _, summary, bad = inspect_directory(spark, root, recursive=True)
    return bad.join(summary, "bigwig_dir").select(
        "position", F.substr("file_path", F.lit(len(paths.absolute(root)) + 2)).alias("file"),
        "file_name", "message", "total_files", "readable", "unreadable")


def q_bigwig_source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 as a data source, in tasks of 64 KB of a file: intervals of 'chr22'
    from 20,000 to 60,000, the chromosome and bounds pushed into the source."""
    root = _encode(spark, sf_dir)
    register_bigwig_source(spark)
    found = (spark.read.format("bigwig").option("recursive", "true").option("chunkBytes", 1 << 16)
             .load(root).where((F.col("chrom") == "chr22") & (F.col("start0") < 60_000)
                               & (F.col("end0") > 20_000)))
    return found.select(F.regexp_extract("file_path", "/cov/([^/]+)/", 1).alias("study_name"),
                        F.regexp_extract("file_path", "/cov/[^/]+/([^/]+)/", 1).alias("qtl_group"),
                        sample_id_from_path("file_path").alias("sample_id"), "chrom", "start0",
                        "end0", nan_to_null("score").alias("score"))


def q_stream_resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9 streaming: a manifest of study_0 with one group named twice; after a
    restart one of all groups; after another restart the same again, when the
    files of one group have changed. How often each group was converted, its
    rows, and how often it was rejected."""
    root = _encode(spark, sf_dir)
    dirs = discover_bigwig_dirs(spark, root).checkpoint(eager=True)
    inbox, state, out = (scratch_path(spark, x) for x in ("inbox", "stream", "streamed"))
    done = f"{out}.done"
    twice = dirs.where("study_name = 'study_0' AND qtl_group = 'grp_1'").withColumn(
        "bigwig_dir", F.concat("bigwig_dir", F.lit("-2")))
    for k, rows in enumerate((dirs.where("study_name = 'study_0'").unionByName(twice), dirs, dirs)):
        written = scratch_path(spark, "manifest")
        write_manifest(rows, written)
        part, = (x for x in paths.children(spark, written) if x.endswith(".csv"))
        paths.rename(spark, f"{written}/{part}", f"{inbox}/manifest-{k}.tsv")
        if k == 2:
            changed = list_bigwig_files(dirs.where("study_name = 'study_2' AND qtl_group = 'grp_1'"))
            touch_files(changed).count()
        start_manifest_stream(spark, inbox, out, state, done_path=done).awaitTermination()
    rejected = read_rejected(spark, done).groupBy(*GROUP_COLUMNS).agg(
        F.count_distinct("batch_id").alias("n_rejected"))
    return (read_done(spark, done).groupBy(*GROUP_COLUMNS)
            .agg(F.count("*").alias("n_converted"), F.max("rows_written").alias("rows_written"))
            .join(rejected, GROUP_COLUMNS, "left")
            .select(*GROUP_COLUMNS, "n_converted", "rows_written",
                    F.coalesce("n_rejected", F.lit(0).cast("long")).alias("n_rejected")))


# --- registry

def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Ship the package to the executors' Python workers before building."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _shipped(fn) for name, fn in {
        "convert_autosomes": q_convert_autosomes,
        "convert_region": q_convert_region,
        "convert_chrom_x": q_convert_chrom_x,
        "chrom_counts": q_chrom_counts,
        "rows_per_file": q_rows_per_file,
        "no_data_files": q_no_data_files,
        "validate_summary": q_validate_summary,
        "null_report": q_null_report,
        "sorted_autosomes": q_sorted_autosomes,
        "row_order": q_row_order,
        "discover_dirs": q_discover_dirs,
        "output_names": q_output_names,
        "chrom_sort_head": q_chrom_sort_head,
        "head_intervals": q_head_intervals,
        "first_chrom_head": q_first_chrom_head,
        "na_rows": q_na_rows,
        "sorted_write_readback": q_sorted_write_readback,
        "validate_written": q_validate_written,
        "bigwig_roundtrip": q_bigwig_roundtrip,
        "bigwig_range": q_bigwig_range,
        "bigwig_chrom_inventory": q_bigwig_chrom_inventory,
        "file_sizes": q_file_sizes,
        "unreadable_files": q_unreadable_files,
        "conversion_failures": q_conversion_failures,
        "inspect_head": q_inspect_head,
        "convert_manifest_job": q_convert_manifest_job,
        "job_rows_per_file": q_job_rows_per_file,
        "convert_study_job": q_convert_study_job,
        "convert_directory_job": q_convert_directory_job,
        "region_tables_side_by_side": q_region_tables_side_by_side,
        "republish_fewer_chromosomes": q_republish_fewer_chromosomes,
        "region_among_long_intervals": q_region_among_long_intervals,
        "incremental_pending": q_incremental_pending,
        "na_rows_written": q_na_rows_written,
        "ordered_directories": q_ordered_directories,
        "damaged_files_job": q_damaged_files_job,
        "validate_with_a_bad_file": q_validate_with_a_bad_file,
        "mixed_names_roundtrip": q_mixed_names_roundtrip,
        "inspect_tree": q_inspect_tree,
        "bigwig_source_scan": q_bigwig_source_scan,
        "stream_resumes": q_stream_resumes,
    }.items()
}
