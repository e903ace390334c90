"""Incremental runs (J9): batch pending-groups and the manifest stream."""

import os

import pytest
from bigwig_writer import write_bigwig
from covtab.paths import delete
from covtab.region import RegionSpec
from covtab.sinks.coverage_parquet import read_coverage
from covtab.sources.listing import discover_bigwig_dirs
from covtab.streaming.incremental import convert_pending, read_done, start_manifest_stream


def make(root, study, group, files, seed=0):
    d = os.path.join(root, study, group, "bigwig")
    os.makedirs(d, exist_ok=True)
    for i, f in enumerate(files):
        iv = {"chr1": [(s, s + 5, float(s + seed)) for s in range(0, 50 * (i + 1), 10)]}
        write_bigwig(os.path.join(d, f), [("chr1", 1000)], iv)


def groups(spark, out):
    df = read_coverage(spark, f"{out}/region=all")
    return {(r.study_name, r.qtl_group): r["count"] for r in df.groupBy("study_name", "qtl_group").count().collect()}


def test_convert_pending_skips_done_groups(spark, tmp_path):
    root, out, done = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "done")
    make(root, "S", "g1", ["a.bw"])
    make(root, "S", "g2", ["b.bw", "c.bw"])
    m = discover_bigwig_dirs(spark, root)
    r1 = convert_pending(spark, m, out, done)
    assert r1.rows_written == 5 + 5 + 10
    assert convert_pending(spark, m, out, done) is None          # nothing changed
    make(root, "S", "g2", ["d.bw"], seed=1)                      # g2 gains a file
    r3 = convert_pending(spark, m, out, done)
    assert r3.rows_written == 5 + 10 + 5
    assert groups(spark, out) == {("S", "g1"): 5, ("S", "g2"): 20}   # g1 kept
    # another region is a different result, in the same output
    r4 = convert_pending(spark, m, out, done, RegionSpec("1"))
    assert r4.rows_written == 25
    assert groups(spark, out) == {("S", "g1"): 5, ("S", "g2"): 20}
    assert convert_pending(spark, m, out, done) is None
    written = {(r.suffix, r.qtl_group): r.rows_written for r in
               spark.read.parquet(done).filter("suffix = '_chr1'").collect()}
    assert written == {("_chr1", "g1"): 5, ("_chr1", "g2"): 20}
    # another output, a file rewritten at the same size, a table that is gone
    assert convert_pending(spark, m, out + "2", done).rows_written == 25
    make(root, "S", "g1", ["a.bw"], seed=1)
    assert convert_pending(spark, m, out, done).rows_written == 5
    delete(spark, f"{out}/region=all/study_name=S/qtl_group=g2")
    assert convert_pending(spark, m, out, done).rows_written == 20
    assert groups(spark, out) == {("S", "g1"): 5, ("S", "g2"): 20}


def test_unreadable_results_table_is_an_error(spark, tmp_path):
    (tmp_path / "done").mkdir()
    (tmp_path / "done" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        read_done(spark, str(tmp_path / "done")).collect()
    assert read_done(spark, str(tmp_path / "missing")).count() == 0


def test_manifest_stream(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    mdir, ck = tmp_path / "manifests", str(tmp_path / "ck")
    mdir.mkdir()
    make(root, "S", "g1", ["a.bw"])
    make(root, "T", "g2", ["b.bw", "c.bw"])
    (mdir / "m1.tsv").write_text(f"study_name\tqtl_group\tbigwig_dir\nS\tg1\t{root}/S/g1/bigwig\n")
    start_manifest_stream(spark, str(mdir), out, ck).awaitTermination()
    assert groups(spark, out) == {("S", "g1"): 5}
    # its own header decides, whatever the order of the columns
    (mdir / "m2.tsv").write_text(f"qtl_group\tbigwig_dir\tstudy_name\ng2\t{root}/T/g2/bigwig\tT\n")
    start_manifest_stream(spark, str(mdir), out, ck).awaitTermination()
    assert groups(spark, out) == {("S", "g1"): 5, ("T", "g2"): 15}


def test_stream_reports_what_it_cannot_convert_and_goes_on(spark, tmp_path):
    from covtab.streaming.incremental import convert_batch, read_rejected
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    mdir, ck = tmp_path / "manifests", str(tmp_path / "ck")
    mdir.mkdir()
    for group in ("g1", "g2"):
        make(root, "S", group, ["a.bw"])

    def manifest(name, *rows):
        (mdir / name).write_text("study_name\tqtl_group\tbigwig_dir\n" + "".join(
            f"S\t{g}\t{root}/S/{d}/bigwig\n" for g, d in rows))
    manifest("m1.tsv", ("g1", "g1"), ("g2", "g2"), ("g2", "g1"), ("g3", "nowhere"))
    start_manifest_stream(spark, str(mdir), out, ck).awaitTermination()
    assert groups(spark, out) == {("S", "g1"): 5}
    left = {(r.qtl_group, r.reason.split()[-1], r.batch_id)
            for r in read_rejected(spark, f"{out}.done").collect()}
    assert left == {("g2", "directories", 0), ("g3", "file", 0)}
    # the next manifest sets g2 right; g1 is done already
    manifest("m2.tsv", ("g1", "g1"), ("g2", "g2"))
    start_manifest_stream(spark, str(mdir), out, ck).awaitTermination()
    assert groups(spark, out) == {("S", "g1"): 5, ("S", "g2"): 5}
    done = read_done(spark, f"{out}.done")
    assert sorted(r.qtl_group for r in done.collect()) == ["g1", "g2"]
    # the first batch again, as after a crash before its commit
    convert_batch(spark, [str(mdir / "m1.tsv")], out, f"{out}.done", 0)
    assert done.count() == 2 and read_rejected(spark, f"{out}.done").count() == 3
