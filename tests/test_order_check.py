"""W1 row-order check against a brute-force scan of the same rows."""

import random

import pytest

from covtab.operators.order_check import check_row_order


def chrom_rank(s):
    try:
        v = int(s)
        if 1 <= v <= 22:
            return v
    except Exception:
        pass
    return 23 if s == "X" else 1000


def brute(rows):
    """rows: list of (group, file, row_index, seqnames, start) -> per group."""
    out = {}
    by_group = {}
    for r in rows:
        by_group.setdefault(r[0], []).append(r)
    for g, rs in by_group.items():
        rs.sort(key=lambda r: (r[1], r[2]))
        pr = ps = None
        nr = ns = 0
        first = None
        for pos, (_, f, _, s, st) in enumerate(rs, start=1):
            rk = chrom_rank(s)
            kind = None
            if pr is not None:
                if rk < pr:
                    kind = "rank"
                elif rk == pr and st is not None and ps is not None and st < ps:
                    kind = "start"
            if kind == "rank":
                nr += 1
            elif kind == "start":
                ns += 1
            if kind and first is None:
                first = (pos, kind, f)
            pr, ps = rk, st
        out[g] = (len(rs), nr, ns, first)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    names = ["1", "2", "2", "3", "X", "Y", "22", "10", "GL1"]
    for g in ["a", "b"]:
        for f in range(rnd.randint(1, 4)):
            n = rnd.randint(0, 300)
            rank_seq = sorted(rnd.choice(names) for _ in range(n))
            for i in range(n):
                s = rank_seq[i] if rnd.random() < 0.95 else rnd.choice(names)
                rows.append((g, f"/t/{g}/part-{f:05d}.parquet", i, s, rnd.randint(0, 50) * (i + 1)))
    df = spark.createDataFrame(rows, "g string, file_path string, row_index long, seqnames string, start int")
    # scatter rows so runs are broken across tasks and batches
    df = df.repartition(rnd.randint(1, 7))
    got = {r["g"]: (r["rows_checked"], r["rank_decreases"], r["start_decreases"],
                    None if r["ok"] else (r["first_bad_row"], r["first_bad_kind"], r["first_bad_file"]))
           for r in check_row_order(df, ["g"]).collect()}
    assert got == brute(rows)


def test_sorted_table_passes(spark):
    rows = [("/f0", i, str(1 + i // 10), i % 10) for i in range(100)]
    df = spark.createDataFrame(rows, "file_path string, row_index long, seqnames string, start int")
    r = check_row_order(df).collect()[0]
    assert r["ok"] and r["rows_checked"] == 100 and r["first_bad_row"] is None


def test_boundary_between_files(spark):
    rows = [("/f0", 0, "2", 5), ("/f0", 1, "2", 7), ("/f1", 0, "1", 9), ("/f1", 1, "1", 10)]
    df = spark.createDataFrame(rows, "file_path string, row_index long, seqnames string, start int")
    r = check_row_order(df).collect()[0]
    assert (r["rank_decreases"], r["start_decreases"], r["first_bad_row"], r["first_bad_kind"],
            r["first_bad_file"]) == (1, 0, 3, "rank", "/f1")


def test_null_start_is_not_a_violation(spark):
    rows = [("/f0", 0, "1", 5), ("/f0", 1, "1", None), ("/f0", 2, "1", 1)]
    df = spark.createDataFrame(rows, "file_path string, row_index long, seqnames string, start int")
    r = check_row_order(df).collect()[0]
    assert r["ok"]


@pytest.mark.parametrize("block", [1, 2, 7, 64])
def test_blocks_of_any_size_agree(spark, monkeypatch, block):
    from covtab.operators import order_check
    rnd = random.Random(block)
    rows = [("g", f"f{f}", i, rnd.choice(["1", "2", "X", "U", None]),
             rnd.choice([None, *range(40)])) for f in range(3) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, file_path string, row_index long, "
                                     "seqnames string, start int").repartition(5)
    monkeypatch.setattr(order_check, "BLOCK_ROWS", block)
    out = check_row_order(df, ["g"])
    r = out.first()
    n, ranks, starts, first = brute(rows)["g"]
    assert (r.rows_checked, r.rank_decreases, r.start_decreases) == (n, ranks, starts)
    assert (r.first_bad_row, r.first_bad_kind, r.first_bad_file) == first
    assert "Python" not in out._jdf.queryExecution().toString()
