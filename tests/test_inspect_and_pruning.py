"""Inspector summaries (A4, A5, J5) and region-query pruning."""

import contextlib
import io
import os

from hypothesis import given, settings
from hypothesis import strategies as st

from bigwig_writer import write_bigwig
from covtab.operators.inspect import directory_summary, file_overview, first_chromosomes
from covtab.plans.jobs import region_query
from covtab.region import RegionSpec
from covtab.sinks.coverage_parquet import write_coverage
from covtab.sources.bigwig import chrom_sizes, readability
from covtab.sources.listing import list_bigwig_paths


def test_directory_summary_and_overview(spark, tmp_path):
    d = tmp_path / "bw"
    d.mkdir()
    write_bigwig(str(d / "a.bw"), [("chr1", 10), ("chr2", 10), ("chrX", 5), ("chr10", 3), ("chrY", 4)],
                 {"chr1": [(0, 2, 1.0)]})
    (d / "b.bw").write_text("junk")
    write_bigwig(str(d / "c.bigwig"), [], {})
    files = list_bigwig_paths(spark, str(d))
    summary, bad = directory_summary(readability(files))
    s = summary.collect()[0]
    assert (s.total_files, s.readable, s.unreadable) == (3, 1, 2)
    assert [(r.position, r.file_name) for r in bad.orderBy("position").collect()] == [(2, "b.bw"), (3, "c.bigwig")]
    sizes = chrom_sizes(files)
    ov = {os.path.basename(r.file_path): (r.n_chroms, r.error is None) for r in file_overview(files, sizes).collect()}
    assert ov["a.bw"] == (5, True) and ov["b.bw"][1] is False
    first = [r.chrom for r in first_chromosomes(sizes.filter("error IS NULL"), 10).orderBy("rn").collect()]
    assert first == ["chr1", "chr2", "chr10", "chrX", "chrY"]


def test_region_query_opens_only_the_chromosome(spark, tmp_path):
    rows = [("S", "g", str(c), s, s + 5, "*", 1.0, "x") for c in (1, 2, 22) for s in range(1, 2000, 7)]
    df = spark.createDataFrame(rows, "study_name string, qtl_group string, seqnames string, start int, "
                                     "`end` int, strand string, score double, sample_id string")
    out = str(tmp_path / "pub")
    write_coverage(df, out, num_partitions=2)
    from pyspark.sql import functions as F
    q = region_query(spark, out, RegionSpec("22"))
    opened = [r[0] for r in q.select(F.input_file_name()).distinct().collect()]
    assert opened and all("chrom_rank=0022" in f for f in opened)
    scan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chrom_rank" in scan


def test_region_query_pushdown(spark, tmp_path):
    rows = [("S", "g", str(c), s, s + 5, "*", 1.0, "x") for c in (1, 2, 22) for s in range(1, 2000, 7)]
    df = spark.createDataFrame(rows, "study_name string, qtl_group string, seqnames string, start int, "
                                     "`end` int, strand string, score double, sample_id string")
    out = str(tmp_path / "pub")
    write_coverage(df, out, num_partitions=3)
    q = region_query(spark, out, RegionSpec("22", 100, 200), study="S")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    plan = buf.getvalue()
    assert "EqualTo(seqnames,22)" in plan
    assert "GreaterThanOrEqual(end,100)" in plan and "LessThanOrEqual(start,200)" in plan
    assert "PartitionFilters: [isnotnull(study_name" in plan and "(study_name#" in plan
    got = sorted((r.start, r.end) for r in q.collect())
    assert got == sorted((s, s + 5) for s in range(1, 2000, 7) if s + 5 >= 100 and s <= 200)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["1", "2", "22", "X"]), st.integers(1, 500),
                          st.integers(0, 40)), min_size=1, max_size=60),
       st.sampled_from(["1", "22", "X"]), st.integers(1, 520), st.integers(0, 200))
def test_region_query_matches_brute_force(spark, tmp_path_factory, rows, chrom, lo, width):
    data = [("S", "g", c, s, s + w, "*", float(i), "x") for i, (c, s, w) in enumerate(rows)]
    df = spark.createDataFrame(data, "study_name string, qtl_group string, seqnames string, start int, "
                                     "`end` int, strand string, score double, sample_id string")
    out = str(tmp_path_factory.mktemp("pub"))
    write_coverage(df, out, num_partitions=2)
    region = RegionSpec(chrom, lo, lo + width)
    got = sorted((r.seqnames, r.start, r.end, r.score) for r in region_query(spark, out, region).collect())
    want = sorted((c, s, e, sc) for _, _, c, s, e, _, sc, _ in data
                  if c == chrom and e >= lo and s <= lo + width)
    assert got == want


def test_inspection_jobs(spark, tmp_path):
    from covtab.plans.jobs import inspect_directory, inspect_files, null_report
    d = tmp_path / "bw"
    d.mkdir()
    write_bigwig(str(d / "a.bw"), [("chr2", 100), ("chr1", 100), ("chrUn", 50)],
                 {"chr1": [(0, 5, 1.0), (10, 20, 2.0)], "chr2": [(30, 40, 3.0)], "chrUn": [(1, 2, 4.0)]})
    (d / "z.bw").write_text("junk")
    per_file, summary, bad = inspect_directory(spark, str(d))
    assert summary.collect()[0].unreadable == 1
    assert [r.file_name for r in bad.collect()] == ["z.bw"]
    ov, first, head, failures = inspect_files(spark, str(d / "a.bw"), start=15)
    assert ov.collect()[0].n_chroms == 3
    assert [r.chrom for r in first.orderBy("rn").collect()] == ["chr1", "chr2", "chrUn"]
    assert [(r.chrom, r.start0) for r in head.collect()] == [("chr1", 10)]
    assert failures.count() == 0
    _, _, head, failures = inspect_files(spark, str(d))
    assert {os.path.basename(r.file_path) for r in head.collect()} == {"a.bw"}
    assert [os.path.basename(r.file_path) for r in failures.collect()] == ["z.bw"]
    for wrong in ({"chrom": "chrNOPE"}, {"chrom": "1", "start": 90}):
        _, _, head, failures = inspect_files(spark, str(d / "a.bw"), **wrong)
        assert head.count() == 0 and failures.count() == 1
    ov, first, head, failures = inspect_files(spark, str(d / "a.bw"), chrom="2")
    assert [(r.chrom, r.start0) for r in head.collect()] == [("chr2", 30)]
    import pytest
    with pytest.raises(ValueError):
        inspect_files(spark, str(d / "a.bw"), start=5, end=5)
    p = str(tmp_path / "t")
    spark.createDataFrame([("1", 1, 2, "*", None, "a"), ("1", 3, 4, "*", float("nan"), "a"),
                           ("1", 5, 6, "*", 1.0, "a")],
                          "seqnames string, start int, `end` int, strand string, score double, sample_id string"
                          ).coalesce(1).write.parquet(p)
    counts, rows = null_report(spark, p)
    c = {r.column_name: r.na_count for r in counts.collect()}
    assert c["score"] == 2 and c["start"] == 0
    assert [r.start for r in rows.collect()] == [1, 3]
    with pytest.raises(FileNotFoundError):
        null_report(spark, str(tmp_path / "missing"))
