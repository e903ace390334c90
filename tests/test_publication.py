"""Publishing by renames, the file index, and split points from the inputs."""

import os

import pytest
from bigwig_writer import write_bigwig
from pyspark.sql import functions as F

from covtab import paths
from covtab.operators.validate import validate_dataset
from covtab.plans.jobs import convert_directory, convert_manifest, region_query
from covtab.region import RegionSpec
from covtab.sinks import coverage_parquet, file_index, publication
from covtab.sinks.coverage_parquet import read_coverage, write_coverage

SCHEMA = ("study_name string, qtl_group string, seqnames string, start int, `end` int, "
          "strand string, score double, sample_id string")
GROUPS = [("S", "a"), ("S", "b/c d"), ("T=1", "a")]


def rows(spark, score, chroms, groups=GROUPS):
    return spark.createDataFrame([(s, g, c, p, p + 5, "*", score, "x") for s, g in groups
                                  for c in chroms for p in (1, 10, 30)], SCHEMA)


def state(spark, root):
    """Chromosomes and scores of each table."""
    found = read_coverage(spark, root).groupBy("study_name", "qtl_group").agg(
        F.array_sort(F.collect_set("seqnames")).alias("c"), F.collect_set("score").alias("v"))
    return {(r.study_name, r.qtl_group): (r.c, r.v) for r in found.collect()}


OLD, NEW = (["1", "2", "3"], [1.0]), (["2"], [2.0])


@pytest.mark.parametrize("moves", range(7))
def test_a_crash_between_any_two_moves(spark, tmp_path, monkeypatch, moves):
    out = str(tmp_path / "out")
    root = write_coverage(rows(spark, 1.0, ["1", "2", "3"]), out)
    real, done = paths.rename, []

    def rename(session, path, to):
        if "/old/" in to or "/new/" in path:  # not the index's own moves
            if "_files" not in to:
                if len(done) == moves:
                    raise KeyboardInterrupt
                done.append(to)
        real(session, path, to)
    monkeypatch.setattr(paths, "rename", rename)
    if moves < 6:
        with pytest.raises(KeyboardInterrupt):
            write_coverage(rows(spark, 2.0, ["2"]), out)
    else:
        write_coverage(rows(spark, 2.0, ["2"]), out)
    monkeypatch.setattr(paths, "rename", real)
    between = state(spark, root)
    assert all(v in (OLD, NEW) for v in between.values())  # never a mixed table
    assert len(between) >= len(GROUPS) - 1
    assert sum(v == NEW for v in between.values()) == moves // 2
    publication.finish_publications(spark, out, RegionSpec())
    assert state(spark, root) == {g: NEW for g in GROUPS}
    assert not paths.children(spark, f"{out}/_publish/all")


def test_a_crash_while_writing_changes_nothing(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    root = write_coverage(rows(spark, 1.0, ["1", "2", "3"]), out)

    def fails(*args):
        raise OSError("disk")
    with monkeypatch.context() as m:
        m.setattr(coverage_parquet, "write_index", fails)
        with pytest.raises(OSError):
            write_coverage(rows(spark, 2.0, ["2"]), out)
    assert state(spark, root) == {g: OLD for g in GROUPS}
    write_coverage(rows(spark, 2.0, ["2"], GROUPS[:1]), out)  # removes the rest of the first
    assert state(spark, root) == {GROUPS[0]: NEW, GROUPS[1]: OLD, GROUPS[2]: OLD}
    assert not paths.children(spark, f"{out}/_publish/all")


def test_a_republication_shuffles_no_more_than_the_first(spark, tmp_path):
    out, n = str(tmp_path / "out"), []
    sc = spark.sparkContext
    for k in range(3):
        sc.setJobGroup(f"publish-{k}", "")
        write_coverage(rows(spark, float(k), ["1", "2"]), out)
        tracker = sc.statusTracker()
        n.append(sum(len(tracker.getJobInfo(j).stageIds)
                     for j in tracker.getJobIdsForGroup(f"publish-{k}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert n[1] == n[2] == n[0]


def test_one_table_and_empty_tables(spark, tmp_path):
    out = str(tmp_path / "out")
    d = tmp_path / "y"
    d.mkdir()
    write_bigwig(str(d / "y.bw"), [("chrY", 100)], {"chrY": [(0, 5, 1.0)]})
    res = convert_directory(spark, str(d), out, allow_empty=True)
    assert read_coverage(spark, res.table).count() == 0
    write_bigwig(str(d / "z.bw"), [("chr1", 100)], {"chr1": [(0, 5, 1.0)]})
    res = convert_directory(spark, str(d), out)
    assert read_coverage(spark, res.table).count() == 1
    assert region_query(spark, out, RegionSpec("1", 2, 3)).count() == 1
    assert region_query(spark, out, RegionSpec("1", 7, 9)).count() == 0
    gone = write_coverage(rows(spark, 1.0, ["1"], GROUPS[:1]), str(tmp_path / "g"),
                          empty=spark.createDataFrame([("S", "q?%é")],
                                                      "study_name string, qtl_group string"))
    tables = publication.table_paths(spark, gone, 2)
    assert len(tables) == 2 and read_coverage(spark, gone).count() == 3


def opened(df):
    return {f.rsplit("/region=", 1)[1] for f in df.inputFiles()}


def test_files_are_picked_by_the_index(spark, tmp_path):
    out = str(tmp_path / "out")
    made = (spark.range(6000).select(
        F.lit("S").alias("study_name"), F.element_at(F.array(F.lit("g"), F.lit("h %/x")),
                                                     (F.col("id") % 2 + 1).cast("int"))
        .alias("qtl_group"), F.lit("22").alias("seqnames"),
        (F.col("id") * 10 + 1).cast("int").alias("start"),
        # the first interval of every thousand is long
        (F.col("id") * 10 + F.when(F.col("id") % 1000 < 2, 15_000).otherwise(5)).cast("int")
        .alias("end"), F.lit("*").alias("strand"), F.col("id").cast("double").alias("score"),
        F.lit("x").alias("sample_id")))
    root = write_coverage(made, out, num_partitions=20)
    every = file_index.read_index(spark, [f"{root}/{t}" for t in
                                          publication.table_paths(spark, root, 2)])
    assert every.agg(F.sum("n_rows")).first()[0] == 6000
    for lo, hi in ((30_001, 30_100), (59_000, 59_100), (1, 1), (500_000, 600_000)):
        region = RegionSpec("22", lo, hi)
        got = region_query(spark, out, region)
        want = made.where((F.col("end") >= lo) & (F.col("start") <= hi))
        assert sorted(r.score for r in got.collect()) == sorted(r.score for r in want.collect())
        holding = {r[0] for r in read_coverage(spark, root).where(
            (F.col("end") >= lo) & (F.col("start") <= hi)).select(F.input_file_name()).distinct()
            .collect()}
        found = opened(got)
        assert len(found) >= len(holding)
        bounds = every.where((F.col("max_end") >= lo) & (F.col("min_start") <= hi))
        assert len(found) == bounds.count() < every.count()
    one = region_query(spark, out, RegionSpec("22", 1, 60_000), study="S", group="h %/x")
    assert one.count() == 3000 and all("h %25%2Fx" in f or "h%20" in f for f in opened(one))
    # a table without an index is read as a whole
    paths.delete(spark, f"{root}/study_name=S/qtl_group=g/_files")
    got = region_query(spark, out, RegionSpec("22", 59_000, 59_100))
    assert sorted(r.start for r in got.collect()) == [50_001, 50_011, *range(59_001, 59_101, 10)]


@pytest.fixture()
def hot_tree(tmp_path):
    """One group with most of the rows, all on one chromosome and half of them
    within a hundredth of it."""
    for group, size in (("hot", 30_000), ("cold", 500)):
        d = tmp_path / "in" / "S" / group / "bigwig"
        d.mkdir(parents=True)
        for name in ("a.bw", "b.bw"):
            dense = [(1_000_000 + 3 * k, 1_000_000 + 3 * k + 2, float(k)) for k in range(size // 2)]
            wide = [(2_000_000 + 400 * k, 2_000_000 + 400 * k + 3, float(k))
                    for k in range(size // 2)]
            write_bigwig(str(d / name), [("chr1", 100_000_000), ("chr2", 100)],
                         {"chr1": dense + wide, "chr2": [(1, 2, 1.0)]}, items_per_block=100)
    return tmp_path / "in" / "S"


def test_ranges_from_the_inputs_indexes(spark, tmp_path, hot_tree):
    manifest = spark.createDataFrame(
        [("S", g, str(hot_tree / g / "bigwig")) for g in ("hot", "cold")],
        "study_name string, qtl_group string, bigwig_dir string")
    out = str(tmp_path / "out")
    res = convert_manifest(spark, manifest, out, rows_per_output_partition=5_000)
    assert res.rows_written == 61_004
    report = validate_dataset(spark, res.table).collect()
    assert {r.status for r in report} <= {"OK", "INFO", "SKIP"}
    parts = (spark.read.parquet(res.table).select(F.input_file_name().alias("f")).groupBy(
        F.regexp_extract("f", r"part-(\d+)", 1).alias("part")).count().collect())
    assert len(parts) >= 11
    assert max(r["count"] for r in parts) <= 2 * 5_000


def test_no_sampling_pass(spark, tmp_path, hot_tree, monkeypatch):
    plans = []
    real = coverage_parquet._ranked

    def ranked(*args):
        plans.append(real(*args)._jdf.queryExecution().executedPlan().toString())
        return real(*args)
    monkeypatch.setattr(coverage_parquet, "_ranked", ranked)
    convert_directory(spark, str(hot_tree / "hot" / "bigwig"), str(tmp_path / "out"),
                      rows_per_output_partition=10_000)
    assert "shufflepartitionidpassthrough" in plans[0]
    assert "rangepartitioning" not in plans[0]


def test_a_bad_file_spoils_its_table_only(spark, tmp_path):
    out = str(tmp_path / "out")
    root = write_coverage(rows(spark, 1.0, ["1", "2"]), out)
    bad = str(tmp_path / "bad")
    rows(spark, 1.0, ["1"]).select("seqnames", "end").coalesce(1).write.parquet(bad)
    file, = (x for x in os.listdir(bad) if x.endswith(".parquet"))
    table, = (t for t in publication.table_paths(spark, root, 2) if "b%2Fc d" in t)
    for k in range(2):
        paths.copy(spark, f"{bad}/{file}", f"{root}/{table}/chrom_rank=0001/part-9999{k}.parquet")
    report = validate_dataset(spark, root).collect()
    by_table = {g: [r for r in report if (r.study_name, r.qtl_group) == g] for g in GROUPS}
    assert sum(map(len, by_table.values())) == len(report)
    spoilt = by_table[GROUPS[1]]
    assert sorted(r.detail[-60:] for r in spoilt if r.status == "FAIL")
    assert [r.check for r in spoilt if r.status == "FAIL"] == ["schema"] * 2
    assert all(f"part-9999{k}" in r.detail for k, r in enumerate(
        sorted((r for r in spoilt if r.status == "FAIL"), key=lambda r: r.detail)))
    assert {r.status for r in spoilt} == {"FAIL", "SKIP"} and len(spoilt) == 12
    for g in (GROUPS[0], GROUPS[2]):
        assert {r.status for r in by_table[g]} <= {"OK", "INFO", "SKIP"}
        assert sum(r.check == "chromosomes" for r in by_table[g]) == 2
