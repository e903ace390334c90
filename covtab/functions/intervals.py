"""Interval expressions: coordinate conversion, sample ids and filters
(P2-P5, P9, F1-F4). All are plain Column builders so Catalyst sees them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covtab.functions.chrom import normalize_chrom
from covtab.region import RegionSpec
from covtab.schema import STRAND


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def one_based_start(start0: Column | str) -> Column:
    """0-based half-open start -> 1-based inclusive start. ANSI cast, so an
    int32 overflow fails the job instead of wrapping (P5)."""
    return (_c(start0).cast("long") + 1).cast("int")


def one_based_end(end0: Column | str) -> Column:
    """The half-open end is already the 1-based inclusive end."""
    return _c(end0).cast("int")


def sample_id_from_path(path: Column | str) -> Column:
    """File name up to its first dot (a.rep2.bw -> a; .h.bw -> '')."""
    base = F.substring_index(_c(path), "/", -1)
    return F.substring_index(base, ".", 1)


def nan_to_null(score: Column | str) -> Column:
    """P5: NaN scores become NULL in the published table."""
    s = _c(score)
    return F.when(F.isnan(s), F.lit(None).cast("double")).otherwise(s)


def strand() -> Column:
    """Strand is always '*'."""
    return F.lit(STRAND)


def chrom_allowed(seqnames: Column | str, region: RegionSpec) -> Column:
    """allow-list applied to the normalised name."""
    allowed = region.allowed_chroms
    c = _c(seqnames)
    return c == allowed[0] if len(allowed) == 1 else c.isin(allowed)


def non_empty(start: Column | str = "start", end: Column | str = "end") -> Column:
    """drop zero-length intervals (end < start after conversion)."""
    return _c(end) >= _c(start)


def overlaps(region: RegionSpec, start: Column | str = "start",
             end: Column | str = "end") -> Column | None:
    """1-based overlap with the region bounds; intervals are not clipped."""
    cond = None
    if region.pos_start is not None:
        cond = _c(end) >= F.lit(region.pos_start)
    if region.pos_end is not None:
        c2 = _c(start) <= F.lit(region.pos_end)
        cond = c2 if cond is None else cond & c2
    return cond


def raw_overlaps(region: RegionSpec, start0: Column | str = "start0",
                 end0: Column | str = "end0") -> Column | None:
    """F3 restated on raw 0-based half-open coordinates, used to prune before
    conversion: end >= s  <=>  end0 >= s;  start <= e  <=>  start0 < e."""
    cond = None
    if region.pos_start is not None:
        cond = _c(end0) >= F.lit(region.pos_start)
    if region.pos_end is not None:
        c2 = _c(start0) < F.lit(region.pos_end)
        cond = c2 if cond is None else cond & c2
    return cond


def region_predicate(region: RegionSpec, seqnames: Column | str = "seqnames",
                     start: Column | str = "start", end: Column | str = "end") -> Column:
    """F1 + F3 (+ F4 when a chromosome is chosen) on a converted table."""
    cond = chrom_allowed(seqnames, region)
    ov = overlaps(region, start, end)
    return cond if ov is None else cond & ov


def study_from_bigwig_dir(path: Column | str) -> Column:
    """study = grandparent of the 'bigwig' directory."""
    return F.regexp_extract(_c(path), r"([^/]+)/([^/]+)/bigwig/?$", 1)


def group_from_bigwig_dir(path: Column | str) -> Column:
    """qtl_group = parent of the 'bigwig' directory."""
    return F.regexp_extract(_c(path), r"([^/]+)/([^/]+)/bigwig/?$", 2)
