"""Interval conversion (P1-P5, F1-F3) and per-file accounting (A1-A3).

``convert_intervals`` is lazy: it only adds Column expressions to the plan, so
filters and projections fuse into one whole-stage-codegen span right after the
scan that produced the raw intervals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.functions.chrom import normalize_chrom
from covtab.functions.intervals import (chrom_allowed, nan_to_null, non_empty,
                                        one_based_end, one_based_start, raw_overlaps,
                                        sample_id_from_path, strand)
from covtab.region import RegionSpec
from covtab.schema import GROUP_COLUMNS, OUTPUT_COLUMNS

INT_MAX = 2147483647
SAMPLE_LISTED = 20  # rows an error message shows; the full list is a table


def convert_intervals(raw: DataFrame, region: RegionSpec | None = None,
                      keep_file_path: bool = False) -> DataFrame:
    """Raw intervals (D2) -> coverage rows (D1) plus the (study, group) keys.

    Order of rules: normalise the name and keep allowed chromosomes (F1),
    shift to 1-based (P2), drop empty intervals (F2), keep region overlaps
    (F3), then attach sample id, strand and NULL-for-NaN score (P3-P5).
    Duplicates are kept (U1, U2).

    If the scan has an ``error`` column, its error rows pass through with
    their data columns NULL, and a coordinate beyond int32 becomes an error of
    its file, so one pass feeds both the table and the failure list (A3).
    """
    region = region or RegionSpec()
    has_errors = "error" in raw.columns
    df = raw
    err = F.lit(False)
    if has_errors:
        overflow = ((F.col("start0").cast("long") + 1 > INT_MAX)
                    | (F.col("end0").cast("long") > INT_MAX))
        df = df.withColumn("error", F.coalesce("error", F.when(overflow, F.concat(
            F.lit("coordinate out of int32 range on "), F.col("chrom")))))
        err = F.col("error").isNotNull()
    pre = raw_overlaps(region)
    if pre is not None:
        # Same rows as F3 after conversion; stated on raw columns so it can
        # reach the scan (or the BigWig block index) before conversion.
        df = df.filter(err | pre)

    def data(column):
        return F.when(~err, column) if has_errors else column
    df = df.select(
        *[c for c in GROUP_COLUMNS if c in raw.columns],
        "file_path",
        data(normalize_chrom(F.col("chrom"))).alias("seqnames"),
        data(one_based_start("start0")).alias("start"),
        data(one_based_end("end0")).alias("end"),
        strand().alias("strand"),
        nan_to_null("score").alias("score"),
        sample_id_from_path("file_path").alias("sample_id"),
        *(["error"] if has_errors else []),
    )
    df = df.filter(err | (chrom_allowed("seqnames", region) & non_empty()))
    cols = [c for c in GROUP_COLUMNS if c in raw.columns] + OUTPUT_COLUMNS
    return df.select(*cols, *(["file_path"] if keep_file_path else []),
                     *(["error"] if has_errors else []))


def rows_per_file(files: DataFrame, converted: DataFrame) -> DataFrame:
    """A1-A3: every row of ``files`` (file_path and its group columns) with
    ``rows_written`` (zero if it kept none) and, where ``converted`` carries
    errors, its first ``error``. A file listed under two groups is counted for
    each. A partial and a final hash aggregate: a hot file ships one partial
    count per task."""
    keys = files.columns
    failed = F.col("error") if "error" in converted.columns else F.lit(None).cast("string")
    counts = converted.groupBy(*keys).agg(
        F.count_if(failed.isNull()).alias("rows_written"), F.min(failed).alias("error"))
    match = [files[k].eqNullSafe(counts[k]) for k in keys]
    out = (files.join(counts, match, "left")
           .select(*[files[k] for k in keys],
                   F.coalesce("rows_written", F.lit(0).cast("long")).alias("rows_written"),
                   "error"))
    return out if "error" in converted.columns else out.drop("error")


def no_data_files(per_file: DataFrame) -> DataFrame:
    """A2: files that opened but kept no rows (a warning, not a failure)."""
    empty = per_file.filter(F.col("rows_written") == 0)
    return empty.filter(F.col("error").isNull()).drop("error") if "error" in per_file.columns \
        else empty


def failed_files(per_file: DataFrame) -> DataFrame:
    """Every file that could not be read, in path order."""
    return (per_file.filter(F.col("error").isNotNull()).select("file_path", "error").distinct()
            .orderBy("file_path", "error"))


class ConversionError(RuntimeError):
    """A3: at least one input could not be read; nothing was written.
    ``n_failed`` is exact, ``report`` holds the whole list (a Parquet table of
    file_path and error), ``sample`` its first rows."""

    def __init__(self, n_failed: int, report: str, sample: list[tuple[str, str]]):
        self.n_failed, self.report, self.sample = n_failed, report, sample
        shown = "\n".join(f"  {p}: {e}" for p, e in sample)
        super().__init__(f"{n_failed} input file(s) are unreadable, so nothing was published. "
                         f"All of them are listed in {report}; the first {len(sample)}:\n{shown}")


class EmptyResultError(RuntimeError):
    """An input group contributed no row, so it has no table to publish."""
