"""Directory discovery, file listing and manifests on hand-made trees."""

import os

import pytest

from covtab.region import RegionSpec
from covtab.sources.listing import (DiscoveryError, discover_bigwig_dirs, list_bigwig_files,
                                    list_bigwig_paths, require_files)
from covtab.sources.manifest import (ManifestError, check_manifest, planned_outputs,
                                     read_manifest, write_manifest)


def touch(path, data=b"x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


@pytest.fixture()
def tree(tmp_path):
    root = tmp_path / "rnaseq"
    for d in ["s1/q1/bigwig", "s1/q2/bigwig", "s2/q3/other", "s3/q5/bigwig/nested"]:
        os.makedirs(root / d)
    touch(str(root / "s2/q4/bigwig"))            # a file named bigwig
    touch(str(root / "s1/q1/bigwig/A.bw"))
    touch(str(root / "s1/q2/bigwig/B.bigwig"), b"xyz")
    touch(str(root / "s3/q5/bigwig/nested/C.bw"))
    return str(root)


def test_discover_exact_depth(spark, tree):
    rows = [tuple(r) for r in discover_bigwig_dirs(spark, tree).collect()]
    assert rows == [("s1", "q1", f"{tree}/s1/q1/bigwig"),
                    ("s1", "q2", f"{tree}/s1/q2/bigwig"),
                    ("s3", "q5", f"{tree}/s3/q5/bigwig")]


def test_discover_one_study(spark, tree):
    rows = [r["qtl_group"] for r in discover_bigwig_dirs(spark, tree, study="s1").collect()]
    assert rows == ["q1", "q2"]


def test_discover_missing_root(spark, tmp_path):
    with pytest.raises(DiscoveryError):
        discover_bigwig_dirs(spark, str(tmp_path / "nope"))


def test_list_files_and_require(spark, tree):
    dirs = discover_bigwig_dirs(spark, tree)
    files = list_bigwig_files(dirs)
    got = sorted((r["qtl_group"], os.path.basename(r["file_path"]), r["size"]) for r in files.collect())
    assert got == [("q1", "A.bw", 1), ("q2", "B.bigwig", 3)]
    with pytest.raises(DiscoveryError, match="s3/q5/bigwig"):
        require_files(dirs, files)
    rec = list_bigwig_files(dirs, recursive=True)
    assert rec.count() == 3


def test_name_rules(spark, tmp_path):
    d = tmp_path / "bw"
    for n in ["a.bw", "b.bigwig", "c.bigWig", "d.BW", ".h.bw", "_u.bw", "e.bw.gz"]:
        touch(str(d / n))
    got = [os.path.basename(r["file_path"]) for r in list_bigwig_paths(spark, str(d)).collect()]
    assert got == ["_u.bw", "a.bw", "b.bigwig"]


def test_manifest_roundtrip_and_crlf(spark, tmp_path):
    p = tmp_path / "m.tsv"
    p.write_bytes(b"study_name\tqtl_group\tbigwig_dir\textra\r\nS\tG\t/x/S/G/bigwig\t1\r\nT\t2001\t/x/T/2001/bigwig\t2\r\n")
    m = read_manifest(spark, str(p))
    check_manifest(m)
    assert sorted(tuple(r) for r in m.collect()) == [("S", "G", "/x/S/G/bigwig"),
                                                      ("T", "2001", "/x/T/2001/bigwig")]
    out = str(tmp_path / "out_manifest")
    write_manifest(m, out)
    part = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(part) == 1
    text = open(os.path.join(out, part[0]), "rb").read()
    assert text == b"study_name\tqtl_group\tbigwig_dir\nS\tG\t/x/S/G/bigwig\nT\t2001\t/x/T/2001/bigwig\n"
    assert sorted(tuple(r) for r in read_manifest(spark, out).collect()) == sorted(tuple(r) for r in m.collect())


def test_manifest_duplicates_and_empty(spark, tmp_path):
    p = tmp_path / "dup.tsv"
    p.write_text("study_name\tqtl_group\tbigwig_dir\nS\tG\t/a\nS\tG\t/b\n")
    with pytest.raises(ManifestError, match="1 .*more than once.*S/G"):
        check_manifest(read_manifest(spark, str(p)))
    e = tmp_path / "empty.tsv"
    e.write_text("study_name\tqtl_group\tbigwig_dir\n")
    with pytest.raises(ManifestError, match="no row"):
        check_manifest(read_manifest(spark, str(e)))
    with pytest.raises(ManifestError):
        read_manifest(spark, str(tmp_path / "missing.tsv"))


def test_planned_outputs(spark):
    m = spark.createDataFrame([("S", "G", "/d")], "study_name string, qtl_group string, bigwig_dir string")
    r = planned_outputs(m, "/o/", RegionSpec("chr22", 5, None)).collect()[0]
    assert r["output_name"] == "G_chr22_from5.parquet"
    assert r["plan_line"] == "Will write: /o/region=chr22_from5/study_name=S/qtl_group=G"


def test_uri_and_plain_rows_are_listed_each_their_way(spark, tmp_path):
    """Rows are told apart one by one, and '_' names are found either way."""
    for group in ["G", "H"]:
        for name in ["a.bw", "_u.bw", "notes.txt"]:
            touch(str(tmp_path / group / name))
    dirs = spark.createDataFrame(
        [("S", "G", f"file://{tmp_path}/G"), ("S", "H", f"{tmp_path}/H")],
        "study_name string, qtl_group string, bigwig_dir string")
    got = sorted((r.qtl_group, os.path.basename(r.file_path), r.size, r.modified > 0)
                 for r in list_bigwig_files(dirs).collect())
    assert got == [(g, n, 1, True) for g in ["G", "H"] for n in ["_u.bw", "a.bw"]]


def test_pyarrow_listing_has_the_same_entries(tmp_path, monkeypatch):
    from covtab.sources import listing
    touch(str(tmp_path / "d" / "a.bw"), b"xy")
    plain = listing._entries(str(tmp_path))
    monkeypatch.setattr(listing.paths, "is_uri", lambda p: True)
    assert [e[:4] for e in listing._entries(f"file://{tmp_path}")] == [
        ("d", f"file://{tmp_path}/d", True, 0)] and plain[0][2]
    inner = listing._entries(f"file://{tmp_path}/d")
    assert inner[0][0] == "a.bw" and inner[0][3] == 2 and inner[0][4] > 0


def test_unlistable_directory_is_an_error(spark, tmp_path):
    (tmp_path / "S").mkdir()
    os.symlink(tmp_path / "loop", tmp_path / "loop")
    dirs = spark.createDataFrame([("S", "G", str(tmp_path / "loop"))],
                                 "study_name string, qtl_group string, bigwig_dir string")
    with pytest.raises(Exception, match="symbolic links"):
        list_bigwig_files(dirs).collect()


def test_empty_directories_are_counted_beyond_the_sample(spark, tmp_path):
    for k in range(30):
        (tmp_path / f"d{k:02d}").mkdir()
    dirs = spark.createDataFrame([(str(tmp_path / f"d{k:02d}"),) for k in range(30)],
                                 "bigwig_dir string")
    with pytest.raises(DiscoveryError, match="^30 input directories"):
        require_files(dirs, list_bigwig_files(dirs))


def test_recursive_listing_sorts_by_path_components(spark, tmp_path):
    d = tmp_path / "bw"
    for sub in ["b", "b-c"]:
        (d / sub).mkdir(parents=True)
        touch(str(d / sub / "x.bw"))
    got = [os.path.relpath(r["file_path"], str(d)) for r in
           list_bigwig_paths(spark, str(d), recursive=True).collect()]
    assert got == ["b/x.bw", "b-c/x.bw"]


def test_discover_files_through_spark_listing(spark, tree):
    """The URI route (one Spark listing below the root) keeps exactly the
    files of '<root>/<study>/<group>/bigwig' directories."""
    from covtab.sources.listing import discover_bigwig_files
    got = sorted((r.study_name, r.qtl_group, os.path.basename(r.file_path), r.size)
                 for r in discover_bigwig_files(spark, "file://" + tree).collect())
    assert got == [("s1", "q1", "A.bw", 1), ("s1", "q2", "B.bigwig", 3)]
    got = [r.qtl_group for r in discover_bigwig_files(spark, tree, study="s1").collect()]
    assert sorted(got) == ["q1", "q2"]


def test_positions_of_a_hot_directory_are_numbered_over_ranges(spark):
    from covtab.operators.inspect import directory_summary
    names = [("hot", f"/d/hot/{k // 40}/f{k % 40:02d}.bw") for k in range(400)]
    names += [("cold", "/d/cold/a.bw"), ("cold", "/d/cold/b-c/x.bw"), ("cold", "/d/cold/b/x.bw")]
    df = spark.createDataFrame([(d, p, k % 3 > 0, "m") for k, (d, p) in enumerate(names)],
                               "bigwig_dir string, file_path string, ok boolean, message string")
    summary, bad = directory_summary(df.repartition(7))
    assert {(r.bigwig_dir, r.total_files) for r in summary.collect()} == {("hot", 400), ("cold", 3)}
    want = {}
    for d in ("hot", "cold"):
        order = sorted((p for x, p in names if x == d), key=lambda p: p.split("/"))
        want.update({p: k + 1 for k, p in enumerate(order)})
    got = {r.file_path: r.position for r in bad.collect()}
    assert got == {p: want[p] for k, (_, p) in enumerate(names) if k % 3 == 0}


def test_a_vanished_subdirectory_is_an_error(tmp_path, monkeypatch):
    import pandas as pd

    from covtab.sources import listing
    top = str(tmp_path / "gone")

    def listed(directory):
        level = pd.DataFrame([(None, None, top, directory)],
                             columns=["study_name", "qtl_group", "bigwig_dir", "dir"])
        return pd.concat(listing._list_level([level]))
    assert len(listed(top)) == 0
    with pytest.raises(FileNotFoundError):
        listed(f"{top}/below")
    for k in range(10):
        (tmp_path / f"{k}.bw").write_text("")
    monkeypatch.setattr(listing, "LISTED_AT_ONCE", 3)
    assert len(listed(str(tmp_path))) == 10
