"""Convert jobs (J1-J3), the all-or-nothing gate (A3), region queries
and the validator (J6) on the written tables."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bigwig_writer import write_bigwig
from covtab.operators.convert import SAMPLE_LISTED, ConversionError, EmptyResultError
from covtab.operators.validate import ValidationError, validate_dataset
from covtab.plans.jobs import convert_directory, convert_manifest, convert_study, region_query
from covtab.region import Expectation, RegionSpec
from covtab.schema import AUTOSOMES
from covtab.sinks.coverage_parquet import read_coverage


def f32(v):
    return float(np.float32(v))


def make_tree(root, seed=0, nan=False):
    """<root>/<study>/<group>/bigwig/*.bw with random intervals; returns the
    expected converted rows (study, group, seqnames, start, end, score, sample)."""
    rnd = random.Random(seed)
    expected = []
    names = ["chr1", "chr2", "chr22", "chrX", "chrY", "chrM", "chr10", "GL000219.1"]
    for study, group in [("S1", "brain"), ("S1", "2001"), ("S2", "blood")]:
        d = os.path.join(root, study, group, "bigwig")
        os.makedirs(d)
        for k, fname in enumerate(["a.bw", "a.rep2.bw", "b.bigwig", "_c.bw"]):
            iv = {}
            for c in rnd.sample(names, 5):
                s, rows = 0, []
                for _ in range(rnd.randint(0, 60)):
                    s += rnd.randint(0, 30)
                    e = s + rnd.randint(0, 20)
                    v = float("nan") if (nan and rnd.random() < 0.05) else rnd.random() * 10
                    rows.append((s, e, v))
                    s = e
                iv[c] = rows
            write_bigwig(os.path.join(d, fname), [(c, 1_000_000) for c in iv], iv,
                         compressed=bool(k % 2), items_per_block=7, fanout=3)
            sample = fname.split(".")[0]
            for c, rows in iv.items():
                cc = c.replace("chr", "")
                for s, e, v in rows:
                    if cc in AUTOSOMES and e >= s + 1:
                        score = None if v != v else f32(v)
                        expected.append((study, group, cc, s + 1, e, score, sample))
    return expected


def collect(df):
    return sorted((r.study_name, r.qtl_group, r.seqnames, r.start, r.end, r.score, r.sample_id)
                  for r in df.collect())


def test_manifest_job_end_to_end(spark, tmp_path):
    root = str(tmp_path / "rnaseq")
    expected = make_tree(root, seed=1)
    manifest = tmp_path / "studies.tsv"
    manifest.write_text("study_name\tqtl_group\tbigwig_dir\n" + "".join(
        f"{s}\t{g}\t{root}/{s}/{g}/bigwig\n" for s, g in [("S1", "brain"), ("S1", "2001"), ("S2", "blood")]))
    out = str(tmp_path / "out")
    res = convert_manifest(spark, str(manifest), out, num_partitions=5)
    assert res.rows_written == len(expected) and res.files == 12
    back = read_coverage(spark, res.table)
    assert collect(back) == sorted(expected)
    assert sum(r.rows_written for r in res.report.collect()) == len(expected)
    report = validate_dataset(spark, res.table, raise_on_fail=True).collect()
    assert {r.status for r in report} <= {"OK", "INFO", "SKIP"}
    assert {r.qtl_group for r in report} == {"brain", "2001", "blood"}
    # one table: the six columns in the published order, no staged copy left
    one = read_coverage(spark, f"{res.table}/study_name=S1/qtl_group=2001")
    assert one.columns == ["seqnames", "start", "end", "strand", "score", "sample_id"]
    assert one.count() == sum(r[:2] == ("S1", "2001") for r in expected)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert not [f for f in os.listdir(folder) if "staged" in f]


def test_full_and_region_tables_live_side_by_side(spark, tmp_path):
    root = str(tmp_path / "rnaseq")
    expected = make_tree(root, seed=7)
    out = str(tmp_path / "out")
    full = sorted(r for r in expected if r[0] == "S1")
    part = [r for r in full if r[2] == "22"]
    for region in (None, RegionSpec("22"), None):
        res = convert_study(spark, root, "S1", out, region, allow_empty=True)
        want = full if region is None else part
        assert collect(read_coverage(spark, res.table)) == want
    assert collect(read_coverage(spark, f"{out}/region=chr22")) == part
    assert collect(region_query(spark, out, RegionSpec("22"))) == part


def test_rewritten_group_loses_stale_chromosomes(spark, tmp_path):
    d = tmp_path / "in" / "S" / "G" / "bigwig"
    d.mkdir(parents=True)
    out = str(tmp_path / "out")
    for chrom in ("chr1", "chr2"):
        write_bigwig(str(d / "a.bw"), [(chrom, 100)], {chrom: [(0, 5, 1.0)]})
        res = convert_study(spark, str(tmp_path / "in"), "S", out)
    assert [r.seqnames for r in read_coverage(spark, res.table).collect()] == ["2"]


def test_empty_group_raises_or_gets_an_empty_table(spark, tmp_path):
    for group, chrom in (("g1", "chr1"), ("g2", "chrY")):
        d = tmp_path / "in" / "S" / group / "bigwig"
        d.mkdir(parents=True)
        write_bigwig(str(d / "a.bw"), [(chrom, 100)], {chrom: [(0, 5, 1.0)]})
    out = str(tmp_path / "out")
    with pytest.raises(EmptyResultError, match="1 group.*S/g2"):
        convert_study(spark, str(tmp_path / "in"), "S", out)
    assert not os.path.exists(f"{out}/region=all")
    res = convert_study(spark, str(tmp_path / "in"), "S", out, allow_empty=True)
    assert res.rows_written == 1 and res.n_no_data == 1
    assert [os.path.basename(os.path.dirname(os.path.dirname(r.file_path)))
            for r in spark.read.parquet(res.no_data).collect()] == ["g2"]
    empty = read_coverage(spark, f"{res.table}/study_name=S/qtl_group=g2")
    assert empty.count() == 0 and len(empty.columns) == 6


def test_one_directory_under_two_groups_is_counted_for_each(spark, tmp_path):
    d = tmp_path / "bw"
    d.mkdir()
    write_bigwig(str(d / "a.bw"), [("chr1", 100)], {"chr1": [(0, 5, 1.0), (7, 9, 2.0)]})
    m = spark.createDataFrame([("S", g, str(d)) for g in ("g1", "g2")],
                              "study_name string, qtl_group string, bigwig_dir string")
    res = convert_manifest(spark, m, str(tmp_path / "out"))
    assert (res.rows_written, res.files) == (4, 1)
    assert read_coverage(spark, res.table).count() == 4


def test_every_failure_is_reported(spark, tmp_path):
    d = tmp_path / "bw"
    d.mkdir()
    for k in range(SAMPLE_LISTED + 15):
        (d / f"bad{k:03d}.bw").write_text("junk")
    out = str(tmp_path / "out")
    with pytest.raises(ConversionError, match=f"^{SAMPLE_LISTED + 15} ") as e:
        convert_directory(spark, str(d), out)
    assert len(e.value.sample) == SAMPLE_LISTED
    listed = [os.path.basename(r.file_path) for r in
              spark.read.parquet(e.value.report).orderBy("file_path").collect()]
    assert listed == [f"bad{k:03d}.bw" for k in range(SAMPLE_LISTED + 15)]


def test_study_job_and_region(spark, tmp_path):
    root = str(tmp_path / "rnaseq")
    expected = make_tree(root, seed=2)
    out = str(tmp_path / "out")
    region = RegionSpec("chr2", 100, 900)
    res = convert_study(spark, root, "S1", out, region, num_partitions=3, allow_empty=True)
    want = sorted(r for r in expected if r[0] == "S1" and r[2] == "2" and r[4] >= 100 and r[3] <= 900)
    assert collect(read_coverage(spark, res.table)) == want
    filled = read_coverage(spark, res.table).count() > 0
    report = validate_dataset(spark, res.table, Expectation.of(region))
    assert filled and report.filter("status = 'FAIL'").count() == 0
    # J8 on the published output
    q = region_query(spark, out, RegionSpec("2", 200, 300), study="S1", group="brain",
                     published=region)
    assert collect(q) == sorted(r for r in want if r[1] == "brain" and r[4] >= 200 and r[3] <= 300)


def test_directory_job_gate(spark, tmp_path):
    root = str(tmp_path / "rnaseq")
    make_tree(root, seed=3)
    d = os.path.join(root, "S2", "blood", "bigwig")
    with open(os.path.join(d, "broken.bw"), "wb") as f:
        f.write(b"not a bigwig at all")
    out = str(tmp_path / "out")
    with pytest.raises(ConversionError) as e:
        convert_directory(spark, d, out)
    assert [os.path.basename(p) for p, _ in e.value.sample] == ["broken.bw"]
    assert not os.path.exists(out)


def test_directory_job_nan_and_empty(spark, tmp_path):
    root = str(tmp_path / "rnaseq")
    expected = make_tree(root, seed=4, nan=True)
    d = os.path.join(root, "S1", "brain", "bigwig")
    out = str(tmp_path / "out")
    res = convert_directory(spark, d, out)
    back = read_coverage(spark, res.table)
    assert back.columns == ["seqnames", "start", "end", "strand", "score", "sample_id"]
    want = sorted(r[2:] for r in expected if r[:2] == ("S1", "brain"))
    assert sorted((r.seqnames, r.start, r.end, r.score, r.sample_id) for r in back.collect()) == want
    rep = {r.check: r for r in validate_dataset(spark, res.table).collect()}
    has_nan = any(r[3] is None for r in want)
    assert rep["no_nulls"].status == ("FAIL" if has_nan else "OK")
    assert rep["row_order"].status == "OK"
    # only chrY -> nothing to publish
    y = tmp_path / "y"
    y.mkdir()
    write_bigwig(str(y / "y.bw"), [("chrY", 100)], {"chrY": [(0, 5, 1.0)]})
    with pytest.raises(EmptyResultError):
        convert_directory(spark, str(y), str(tmp_path / "out_y"))


def write_table(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


GOOD = "seqnames string, start int, end int, strand string, score double, sample_id string"


@pytest.mark.parametrize("case,rows,schema,check", [
    ("order", [("1", 1, 2, "*", 1.0, "a")], "start int, seqnames string, end int, strand string, score double, sample_id string", "schema"),
    ("long", [("1", 1, 2, "*", 1.0, "a")], "seqnames string, start long, end int, strand string, score double, sample_id string", "schema"),
    ("null", [("1", 1, 2, "*", None, "a")], GOOD, "no_nulls"),
    ("strand", [("1", 1, 2, "+", 1.0, "a")], GOOD, "strand"),
    ("start0", [("1", 0, 2, "*", 1.0, "a")], GOOD, "valid_intervals"),
    ("end_lt", [("1", 5, 2, "*", 1.0, "a")], GOOD, "valid_intervals"),
    ("empty", [], GOOD, "row_count"),
    ("unsorted_rank", [("2", 1, 2, "*", 1.0, "a"), ("1", 5, 6, "*", 1.0, "a")], GOOD, "row_order"),
    ("unsorted_start", [("1", 9, 12, "*", 1.0, "a"), ("1", 5, 6, "*", 1.0, "a")], GOOD, "row_order"),
])
def test_validator_catches(spark, tmp_path, case, rows, schema, check):
    p = str(tmp_path / case)
    if case == "order":
        rows = [(r[1], r[0], *r[2:]) for r in rows]
    write_table(spark, p, rows, schema)
    with pytest.raises(ValidationError, match=check):
        validate_dataset(spark, p, raise_on_fail=True)


def test_validator_expectations(spark, tmp_path):
    p = str(tmp_path / "t")
    write_table(spark, p, [("22", 10, 20, "*", 1.0, "a"), ("22", 30, 40, "*", 1.0, "b")], GOOD)
    rep = {r.check: (r.status, r.n_bad) for r in validate_dataset(spark, p, Expectation("chr22", 15, 35)).collect()}
    assert rep["expected_chrom"] == ("OK", 0)
    assert rep["expected_pos_start"] == ("OK", 0) and rep["expected_pos_end"] == ("OK", 0)
    rep = {r.check: (r.status, r.n_bad) for r in validate_dataset(spark, p, Expectation("1", 25, 29)).collect()}
    assert rep["expected_chrom"] == ("FAIL", 2)
    assert rep["expected_pos_start"] == ("FAIL", 1) and rep["expected_pos_end"] == ("FAIL", 1)
    assert rep["samples"][0] == "INFO"


def test_row_order_across_file_boundary(spark, tmp_path):
    p = str(tmp_path / "two_files")
    os.makedirs(p)
    import pyarrow as pa
    import pyarrow.parquet as pq
    from covtab.schema import OUTPUT_COLUMNS
    sch = pa.schema([("seqnames", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                     ("strand", pa.string()), ("score", pa.float64()), ("sample_id", pa.string())])
    def t(rows):
        return pa.Table.from_pylist([dict(zip(OUTPUT_COLUMNS, r)) for r in rows], schema=sch)
    pq.write_table(t([("1", 1, 2, "*", 1.0, "a"), ("1", 50, 60, "*", 1.0, "a")]), f"{p}/part-00000.parquet")
    pq.write_table(t([("1", 40, 45, "*", 1.0, "a"), ("2", 1, 2, "*", 1.0, "a")]), f"{p}/part-00001.parquet")
    rep = {r.check: r for r in validate_dataset(spark, p).collect()}
    assert rep["row_order"].status == "FAIL"
    assert "row 3" in rep["row_order"].detail and "start" in rep["row_order"].detail


def table_of(rows):
    import pyarrow as pa
    from covtab.schema import OUTPUT_COLUMNS
    sch = pa.schema([("seqnames", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                     ("strand", pa.string()), ("score", pa.float64()), ("sample_id", pa.string())])
    return pa.Table.from_pylist([dict(zip(OUTPUT_COLUMNS, r)) for r in rows], schema=sch)


def test_every_footer_is_checked(spark, tmp_path):
    import pyarrow.parquet as pq
    good = table_of([("1", 1, 2, "*", 1.0, "a")])
    for case, bad in (("order", good.select(["start", "seqnames", "end", "strand", "score",
                                             "sample_id"])),
                      ("missing", good.drop_columns(["score"]))):
        p = tmp_path / case
        p.mkdir()
        pq.write_table(good, p / "part-00000.parquet")
        pq.write_table(bad, p / "part-00001.parquet")
        rep = {r.check: r for r in validate_dataset(spark, str(p)).collect()}
        assert rep["schema"].status == "FAIL" and rep["schema"].n_bad == 1
        assert "part-00001" in rep["schema"].detail
        assert {r.status for c, r in rep.items() if c != "schema"} == {"SKIP"}


def test_parts_are_ordered_by_number(spark, tmp_path):
    import pyarrow.parquet as pq
    p = tmp_path / "t"
    p.mkdir()
    pq.write_table(table_of([("1", 1, 2, "*", 1.0, "a")]), p / "part-99999.parquet")
    pq.write_table(table_of([("1", 5, 6, "*", 1.0, "a")]), p / "part-100000.parquet")
    rep = {r.check: r for r in validate_dataset(spark, str(p)).collect()}
    assert rep["row_order"].status == "OK"


def test_validator_with_a_sample_for_every_row(spark, tmp_path):
    p = str(tmp_path / "t")
    rows = spark.range(3000).selectExpr(
        "concat('c', id % 700) AS seqnames", "cast(id + 1 AS int) AS start",
        "cast(id + 2 AS int) AS end", "'*' AS strand", "1.0D AS score",
        "concat('s', id) AS sample_id")
    rows.coalesce(1).write.parquet(p)
    rep = validate_dataset(spark, p).collect()
    assert [r.detail for r in rep if r.check == "samples"] == ["3000 samples"]
    assert sum(r.check == "chromosomes" for r in rep) == 700


def test_int32_overflow_fails_its_file(spark, tmp_path):
    d = tmp_path / "bw"
    d.mkdir()
    write_bigwig(str(d / "ok.bw"), [("chr1", 100)], {"chr1": [(0, 5, 1.0)]})
    write_bigwig(str(d / "big.bw"), [("chr1", 4_000_000_000)],
                 {"chr1": [(0, 5, 1.0), (2_147_483_647, 2_147_483_650, 2.0)]})
    with pytest.raises(ConversionError) as e:
        convert_directory(spark, str(d), str(tmp_path / "out"))
    assert [os.path.basename(p) for p, _ in e.value.sample] == ["big.bw"]
    assert "int32" in e.value.sample[0][1]


def test_hot_group_is_split_and_stays_ordered(spark, tmp_path):
    """One (study, group) with most rows, many tied starts: the range shuffle
    spreads it over several tasks (files) and the table stays in order."""
    from pyspark.sql import functions as F
    from covtab.sinks.coverage_parquet import write_coverage
    hot = (spark.range(0, 40_000)
           .select(F.lit("S").alias("study_name"), F.lit("hot").alias("qtl_group"),
                   (F.col("id") % 22 + 1).cast("string").alias("seqnames"),
                   (F.expr("id div 22") % 500 * 10 + 1).cast("int").alias("start"),
                   (F.expr("id div 22") % 500 * 10 + 10).cast("int").alias("end"),
                   F.lit("*").alias("strand"), F.lit(1.0).alias("score"),
                   F.concat(F.lit("s"), (F.col("id") % 37).cast("string")).alias("sample_id")))
    cold = hot.limit(500).withColumn("qtl_group", F.lit("cold"))
    out = str(tmp_path / "pub")
    out = write_coverage(hot.unionByName(cold), out, num_partitions=8)
    files = [f for _, _, names in os.walk(f"{out}/study_name=S/qtl_group=hot") for f in names
             if f.endswith(".parquet")]
    assert len({f.split("-")[1] for f in files}) >= 4
    rep = {(r.qtl_group, r.check): r.status for r in validate_dataset(spark, out).collect()}
    assert rep[("hot", "row_order")] == "OK" and rep[("cold", "row_order")] == "OK"
    assert read_coverage(spark, out).count() == 40_500


def test_same_sample_files_are_not_deduplicated(spark, tmp_path):
    d = tmp_path / "bw"
    d.mkdir()
    iv = {"chr1": [(0, 10, 1.0), (20, 30, 2.0)]}
    for name in ["S1.bw", "S1.rep2.bw", "S1.bigwig"]:
        write_bigwig(str(d / name), [("chr1", 100)], iv)
    out = str(tmp_path / "out")
    res = convert_directory(spark, str(d), out)
    assert res.rows_written == 6 and res.files == 3
    rows = sorted((r.sample_id, r.start, r.end) for r in read_coverage(spark, res.table).collect())
    assert rows == [("S1", 1, 10)] * 3 + [("S1", 21, 30)] * 3
