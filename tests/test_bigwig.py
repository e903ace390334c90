"""BigWig scan (S6-S8, A4) on hand-made files of every section type."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from bigwig_writer import write_bigwig
from covtab.operators.convert import convert_intervals
from covtab.region import RegionSpec
from covtab.sources.bigwig import (bigwig_chunks, chrom_sizes, readability, scan_bigwig,
                                   scan_bigwig_range, without_errors)


def f32(v):
    return float(np.float32(v))


def files_df(spark, paths, study="s", group="g"):
    return spark.createDataFrame([(study, group, p) for p in paths],
                                 "study_name string, qtl_group string, file_path string")


def raw_rows(df):
    return sorted((r["chrom"], r["start0"], r["end0"], r["score"]) for r in
                  df.filter("error IS NULL").collect())


CHROMS = [("chr1", 1000), ("chr22", 5000), ("chrX", 800), ("chrM", 100)]
IV = {"chr1": [(0, 10, 1.5), (10, 20, 0.1), (50, 60, 2.0)],
      "chr22": [(100, 150, 3.0), (200, 201, 4.25)],
      "chrX": [(5, 9, 7.0)], "chrM": [(1, 2, 9.0)]}


def expected(iv, names=None):
    return sorted((c, s, e, f32(v)) for c, rows in iv.items() if names is None or c in names
                  for s, e, v in rows)


@pytest.mark.parametrize("compressed", [True, False])
def test_bedgraph_raw_and_default_chroms(spark, tmp_path, compressed):
    p = write_bigwig(str(tmp_path / "S1.bw"), CHROMS, IV, compressed=compressed)
    raw = scan_bigwig(files_df(spark, [p]), all_chroms=True)
    assert raw_rows(raw) == expected(IV)
    # default: autosomes only, X and M pruned at the block index
    default = scan_bigwig(files_df(spark, [p]))
    assert raw_rows(default) == expected(IV, {"chr1", "chr22"})
    conv = convert_intervals(default).collect()
    assert sorted((r.seqnames, r.start, r.end, r.sample_id) for r in conv) == sorted(
        (c.replace("chr", ""), s + 1, e, "S1") for c, s, e, _ in expected(IV, {"chr1", "chr22"}))


@pytest.mark.parametrize("compressed", [True, False])
def test_varstep_and_fixedstep(spark, tmp_path, compressed):
    var = {"chr2": [(s, s + 5, s / 10) for s in (3, 11, 40, 41)]}
    fixed = {"chr3": [(100 + 25 * i, 100 + 25 * i + 10, i * 0.5) for i in range(7)]}
    p1 = write_bigwig(str(tmp_path / "v.bw"), [("chr2", 500)], var, kind=2, compressed=compressed,
                      items_per_block=3)
    p2 = write_bigwig(str(tmp_path / "f.bigwig"), [("chr3", 500)], fixed, kind=3,
                      compressed=compressed, items_per_block=4)
    got = raw_rows(scan_bigwig(files_df(spark, [p1, p2]), all_chroms=True))
    assert got == sorted(expected(var) + expected(fixed))


def test_multi_level_trees(spark, tmp_path):
    chroms = [(f"chr{i}", 10_000) for i in range(1, 23)] + [("chrX", 10_000)]
    iv = {c: [(s, s + 3, (s % 17) / 4) for s in range(0, 300, 7)] for c, _ in chroms}
    p = write_bigwig(str(tmp_path / "m.bw"), chroms, iv, items_per_block=5, fanout=3)
    df = files_df(spark, [p])
    assert raw_rows(scan_bigwig(df, all_chroms=True)) == expected(iv)
    # small chunks: a file is cut into many byte ranges, decoded by many tasks
    chunks = bigwig_chunks(df, all_chroms=True, chunk_bytes=200).collect()
    assert len(chunks) > 5 and sum(r.n_blocks for r in chunks) == 23 * 9
    assert raw_rows(scan_bigwig(df, all_chroms=True, chunk_bytes=200, num_partitions=7)) == expected(iv)
    sizes = chrom_sizes(df).collect()
    assert sorted((r.chrom, r.size) for r in sizes) == sorted(chroms)


def test_mixed_names_zero_length_and_nan(spark, tmp_path):
    iv = {"chr1": [(0, 5, 1.0), (7, 7, 2.0)], "1": [(3, 9, float("nan"))]}
    p = write_bigwig(str(tmp_path / "A.rep2.bw"), [("chr1", 100), ("1", 100)], iv)
    conv = convert_intervals(scan_bigwig(files_df(spark, [p]))).collect()
    rows = sorted(((r.seqnames, r.start, r.end, r.sample_id, r.score) for r in conv),
                  key=lambda t: t[1])
    # both names become '1' (no dedupe); the zero-length interval is dropped;
    # NaN is published as NULL
    assert rows == [("1", 1, 5, "A", 1.0), ("1", 4, 9, "A", None)]


def test_region_prunes_blocks(spark, tmp_path):
    iv = {"chr22": [(s, s + 10, 1.0) for s in range(0, 10_000, 10)]}
    p = write_bigwig(str(tmp_path / "r.bw"), [("chr22", 20_000)], iv, items_per_block=10, fanout=4)
    df = files_df(spark, [p])
    region = RegionSpec("22", 2_001, 2_050)
    chunks = bigwig_chunks(df, region).collect()
    nblocks = sum(r.n_blocks for r in chunks)
    assert 1 <= nblocks <= 2                      # of 100 blocks
    conv = convert_intervals(scan_bigwig(df, region), region).collect()
    got = sorted((r.start, r.end) for r in conv)
    want = sorted((s + 1, s + 10) for s in range(0, 10_000, 10) if s + 10 >= 2_001 and s + 1 <= 2_050)
    assert got == want


def test_only_unwanted_chroms_is_empty_not_error(spark, tmp_path):
    p = write_bigwig(str(tmp_path / "y.bw"), [("chrY", 100)], {"chrY": [(0, 5, 1.0)]})
    out = scan_bigwig(files_df(spark, [p])).collect()
    assert out == []


def test_errors_are_rows(spark, tmp_path):
    good = write_bigwig(str(tmp_path / "good.bw"), CHROMS, IV)
    none = write_bigwig(str(tmp_path / "none.bw"), [], {})
    trunc = str(tmp_path / "trunc.bw")
    with open(good, "rb") as f:
        data = f.read()
    with open(trunc, "wb") as f:
        f.write(data[:-40])                      # cut into the R-tree
    text = str(tmp_path / "text.bw")
    with open(text, "w") as f:
        f.write("track type=bedGraph\nchr1 0 10 1.0\n" * 5)
    corrupt = str(tmp_path / "corrupt.bw")
    with open(corrupt, "wb") as f:
        f.write(b"\0\0\0\0" + data[4:])
    df = files_df(spark, [good, none, trunc, text, corrupt])
    errs = {os.path.basename(r.file_path): r.error for r in
            scan_bigwig(df).filter("error IS NOT NULL").select("file_path", "error").distinct().collect()}
    assert set(errs) == {"none.bw", "trunc.bw", "text.bw", "corrupt.bw"}
    assert "no chromosome" in errs["none.bw"]
    assert "truncated" in errs["trunc.bw"]
    rd = {os.path.basename(r.file_path): (r.ok, r.message) for r in readability(df).collect()}
    assert rd["good.bw"] == (True, "4 chromosomes")
    assert rd["none.bw"][0] is False and "no chromosome" in rd["none.bw"][1]
    assert rd["text.bw"][0] is False and rd["corrupt.bw"][0] is False
    assert rd["trunc.bw"][0] is True              # header and chromosome tree are intact


def test_corrupt_block_is_an_error_row(spark, tmp_path):
    p = write_bigwig(str(tmp_path / "b.bw"), CHROMS, IV)
    data = bytearray(open(p, "rb").read())
    # damage the first data block (right after the u64 block count)
    import struct
    data_off = struct.unpack_from("<Q", data, 16)[0]
    data[data_off + 8:data_off + 14] = b"\xff" * 6
    open(p, "wb").write(bytes(data))
    errs = scan_bigwig(files_df(spark, [p])).filter("error IS NOT NULL").collect()
    assert errs and errs[0].file_path == p


def test_range_scan(spark, tmp_path):
    p = write_bigwig(str(tmp_path / "S.bw"), CHROMS, IV)
    df = files_df(spark, [p])
    got = raw_rows(scan_bigwig_range(df, "chr1", 5, 55))
    assert got == [("chr1", 0, 10, 1.5), ("chr1", 10, 20, f32(0.1)), ("chr1", 50, 60, 2.0)]
    # '1' falls back to 'chr1'; end clamps to the chromosome size
    got2 = raw_rows(scan_bigwig_range(df, "1", 15))
    assert got2 == [("chr1", 10, 20, f32(0.1)), ("chr1", 50, 60, 2.0)]
    for chrom, start, why in (("chr1", 2000, "is empty"), ("chrNOPE", 0, "no chromosome")):
        rows = scan_bigwig_range(df, chrom, start).collect()
        assert [why in r.error for r in rows] == [True]
    with pytest.raises(Exception, match="no chromosome chrNOPE"):
        without_errors(scan_bigwig_range(df, "chrNOPE")).collect()
    with pytest.raises(ValueError):
        scan_bigwig_range(df, "chr1", 5, 5)


def test_exact_name_goes_before_the_other_spelling(spark, tmp_path):
    """One file with both '1' and 'chr1': a conversion merges them (U1), a
    range takes the name as asked for (S8)."""
    from covtab.operators.convert import convert_intervals
    p = write_bigwig(str(tmp_path / "S.bw"), [("1", 100), ("chr1", 100)],
                     {"1": [(0, 5, 1.0)], "chr1": [(7, 9, 2.0)]})
    df = files_df(spark, [p])
    for chrom, start0 in (("1", 0), ("chr1", 7)):
        assert [r.start0 for r in scan_bigwig_range(df, chrom).collect()] == [start0]
    rows = convert_intervals(scan_bigwig(df)).collect()
    assert sorted((r.seqnames, r.start) for r in rows) == [("1", 1), ("1", 8)]


def test_tree_cycles_are_errors(tmp_path):
    import io
    import struct
    from covtab.sources import bigwig_format as fmt
    node = struct.pack("<BBH", 0, 0, 1) + struct.pack("<IIIIQ", 0, 0, 0, 9, 48)
    head = fmt._RT_HEADER.pack(fmt.RTREE_MAGIC, 256, 1, 0, 0, 0, 9, 0, 1, 0)
    f = io.BytesIO(head.ljust(48, b"\0") + node)
    h = fmt.Header(4, 0, 0, 0, 0, 0)
    with pytest.raises(fmt.BigWigError, match="twice"):
        fmt.read_index_leaves(f, h)


def test_datasource_facade(spark, tmp_path):
    from covtab.sources.bigwig_datasource import register_bigwig_source
    register_bigwig_source(spark)
    d = tmp_path / "bw"
    d.mkdir()
    iv = {"chr22": [(s, s + 10, 1.0) for s in range(0, 10_000, 10)], "chr1": [(0, 5, 2.0)]}
    write_bigwig(str(d / "a.bw"), [("chr22", 20_000), ("chr1", 100)], iv, items_per_block=10, fanout=4)
    write_bigwig(str(d / "b.bigwig"), CHROMS, IV)
    df = spark.read.format("bigwig").option("chunkBytes", "100").load(str(d))
    assert df.count() == 1001 + sum(len(v) for v in IV.values())
    q = df.filter("chrom = 'chr22' AND start0 < 2050 AND end0 >= 2001")
    got = sorted((r.file_path.endswith("a.bw"), r.start0, r.end0) for r in q.collect())
    want = sorted((True, s, s + 10) for s in range(0, 10_000, 10) if s < 2050 and s + 10 >= 2001)
    assert got == want
    ranges = sum(-(-os.path.getsize(d / f) // 100) for f in os.listdir(d))
    assert q.rdd.getNumPartitions() == ranges
    assert raw_rows(df.filter("chrom IN ('chrX', 'chrM')").withColumn("error", F.lit(None))) == \
        expected(IV, {"chrX", "chrM"})


def test_bigwig_head_matches_dataframe_operator(spark, tmp_path):
    """The per-file head walk equals the DataFrame operator (O7 + O6) on the
    fully decoded data, for several ranges and a chosen chromosome."""
    from covtab.operators.inspect import first_chrom_head
    from covtab.sources.bigwig import bigwig_head
    chroms = [("chr1", 5000), ("chr2", 300), ("chrX", 5000), ("chr10", 5000), ("chrUn_x", 5000)]
    iv = {"chr1": [(s, s + 7, s / 3) for s in range(2000, 4000, 9)],
          "chr2": [(0, 50, 1.0), (100, 120, 2.0)],
          "chr10": [(s, s + 3, 1.5) for s in range(0, 5000, 11)],
          "chrX": [(10, 20, 9.0)]}
    p1 = write_bigwig(str(tmp_path / "a.bw"), chroms, iv, items_per_block=6, fanout=3)
    p2 = write_bigwig(str(tmp_path / "b.bw"), [("chr3", 1000)], {"chr3": [(5, 6, 1.0)]})
    files = files_df(spark, [p1, p2])
    raw = scan_bigwig(files, all_chroms=True).filter("error IS NULL")
    sizes = chrom_sizes(files).filter("error IS NULL")
    for start, end, chrom in [(0, None, None), (150, None, None), (2500, 2600, None),
                              (400, None, "1"), (0, 30, "chrX"), (6000, None, None)]:
        a = sorted(tuple(r) for r in bigwig_head(files, start, end, 4, chrom).filter("error IS NULL")
                   .select("file_path", "chrom", "start0", "end0", "score", "rn").collect())
        b = sorted(tuple(r) for r in first_chrom_head(raw, sizes, start, end, 4, chrom)
                   .select("file_path", "chrom", "start0", "end0", "score", "rn").collect())
        assert a == b, (start, end, chrom)


def test_source_cuts_a_chromosome_into_byte_ranges(spark, tmp_path):
    from covtab.sources.bigwig_datasource import BigWigReader, register_bigwig_source
    rows = [(k * 10, k * 10 + 7, float(k)) for k in range(5000)]
    d = tmp_path / "deep" / "er"
    d.mkdir(parents=True)
    path = str(d / "a.bw")
    write_bigwig(path, [("chr1", 100_000), ("chr2", 100)], {"chr1": rows, "chr2": [(1, 2, 0.5)]},
                 items_per_block=64)
    (d / "ignored.txt").write_text("x")
    register_bigwig_source(spark)
    size = os.path.getsize(path)
    for step in (500, 4096, 10 * size):
        parts = BigWigReader({"path": str(tmp_path), "recursive": "true",
                              "chunkBytes": str(step)}).partitions()
        assert len(parts) == -(-size // step)
        df = (spark.read.format("bigwig").option("recursive", "true").option("chunkBytes", step)
              .load(str(tmp_path)))
        got = sorted((r.chrom, r.start0, r.end0, r.score) for r in df.collect())
        assert got == sorted([("chr1", *r) for r in rows] + [("chr2", 1, 2, 0.5)])
        some = df.where("chrom = 'chr1' AND start0 < 20100 AND end0 >= 20000")
        assert sorted(r.start0 for r in some.collect()) == list(range(20_000, 20_100, 10))
        busy = (df.where("chrom = 'chr1'").selectExpr("spark_partition_id() AS p").distinct()
                .count())
        assert busy == 1 if step > size else busy > 3
    assert spark.read.format("bigwig").load(path).count() == 5001
    assert spark.read.format("bigwig").load(str(tmp_path)).count() == 0
