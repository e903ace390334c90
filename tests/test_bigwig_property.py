"""Property test: BigWig encode -> distributed decode is exact for any mix of
section types, compression, block sizes, tree fan-outs and chunk sizes."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bigwig_writer import write_bigwig
from covtab.sources.bigwig import scan_bigwig

NAMES = ["chr1", "chr2", "chr10", "chr22", "chrX", "chrY", "1", "GL000219.1"]


@st.composite
def tracks(draw):
    chroms = draw(st.lists(st.sampled_from(NAMES), min_size=1, max_size=5, unique=True))
    iv, kinds = {}, {}
    for c in chroms:
        kind = draw(st.sampled_from([1, 2, 3]))
        n = draw(st.integers(0, 80))
        span = draw(st.integers(1, 30))
        step = draw(st.integers(span, span + 20))
        s0 = draw(st.integers(0, 1000))
        rows = []
        if kind == 1:
            s = s0
            for _ in range(n):
                s += draw(st.integers(0, 40))
                e = s + draw(st.integers(0, 25))
                rows.append((s, e, draw(st.floats(-1e6, 1e6, width=32))))
                s = e
        elif kind == 2:
            s = s0
            for _ in range(n):
                s += draw(st.integers(span, span + 50))
                rows.append((s, s + span, draw(st.floats(-1e3, 1e3, width=32))))
        else:
            rows = [(s0 + i * step, s0 + i * step + span, float(i) / 3) for i in range(max(n, 1))]
        if rows:
            iv[c] = rows
            kinds[c] = kind
    return chroms, iv, kinds


@settings(max_examples=12, deadline=None)
@given(tracks(), st.booleans(), st.integers(1, 40), st.integers(2, 9), st.integers(50, 5000))
def test_roundtrip(spark, tmp_path_factory, track, compressed, per_block, fanout, chunk_bytes):
    chroms, iv, kinds = track
    d = tmp_path_factory.mktemp("bw")
    p = write_bigwig(str(d / "t.bw"), [(c, 10_000_000) for c in chroms], iv,
                     kind={c: kinds.get(c, 1) for c in chroms}, compressed=compressed,
                     items_per_block=per_block, fanout=fanout)
    files = spark.createDataFrame([(p,)], "file_path string")
    got = sorted((r.chrom, r.start0, r.end0, r.score) for r in
                 scan_bigwig(files, all_chroms=True, chunk_bytes=chunk_bytes, num_partitions=3)
                 .filter("error IS NULL").collect())
    want = sorted((c, s, e, float(np.float32(v))) for c, rows in iv.items() for s, e, v in rows)
    assert got == want


class _Counting:
    def __init__(self, f):
        self.f, self.bytes = f, 0

    def seek(self, off):
        self.f.seek(off)

    def read(self, n):
        b = self.f.read(n)
        self.bytes += len(b)
        return b


def test_pruned_index_reads_less(tmp_path):
    from covtab.sources.bigwig_format import read_chroms, read_header, read_index_leaves
    chroms = [(f"chr{i}", 1_000_000) for i in range(1, 23)]
    iv = {c: [(s, s + 5, 1.0) for s in range(0, 20_000, 10)] for c, _ in chroms}
    p = write_bigwig(str(tmp_path / "big.bw"), chroms, iv, items_per_block=8, fanout=4)
    with open(p, "rb") as raw:
        f = _Counting(raw)
        h = read_header(f)
        ids = {n: i for n, i, _ in read_chroms(f, h)}
        f.bytes = 0
        full = read_index_leaves(f, h)
        full_bytes, f.bytes = f.bytes, 0
        part = read_index_leaves(f, h, np.array([ids["chr22"]]), (5_000, 5_100))
        part_bytes = f.bytes
    assert len(full) == 22 * 250
    assert 1 <= len(part) <= 3
    assert part_bytes * 20 < full_bytes


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["chr1", "chr2", "chr22", "22"]), st.integers(0, 3000),
                          st.integers(0, 30)), min_size=1, max_size=150),
       st.sampled_from(["1", "2", "22"]), st.integers(1, 3100), st.integers(0, 400),
       st.integers(1, 6), st.integers(2, 5))
def test_region_pruning_is_exact(spark, tmp_path_factory, rows, chrom, lo, width, per_block, fanout):
    from covtab.operators.convert import convert_intervals
    from covtab.region import RegionSpec
    iv = {}
    for c, s, w in sorted(rows):
        iv.setdefault(c, []).append((s, s + w, float(s)))
    d = tmp_path_factory.mktemp("bw")
    p = write_bigwig(str(d / "S.bw"), [(c, 10_000) for c in iv], iv, items_per_block=per_block,
                     fanout=fanout)
    region = RegionSpec(chrom, lo, lo + width)
    files = spark.createDataFrame([(p,)], "file_path string")
    got = sorted((r.seqnames, r.start, r.end, r.score) for r in
                 convert_intervals(scan_bigwig(files, region, chunk_bytes=64), region).collect())
    want = sorted((c.replace("chr", ""), s + 1, e, float(np.float32(v)))
                  for c, rs in iv.items() for s, e, v in rs
                  if c.replace("chr", "") == chrom and e >= s + 1 and e >= lo and s + 1 <= lo + width)
    assert got == want


def test_overlapping_intervals_across_blocks(spark, tmp_path):
    """An early long interval must still be found by a region near its end."""
    from covtab.operators.convert import convert_intervals
    from covtab.region import RegionSpec
    iv = {"chr22": [(0, 5000, 1.0)] + [(s, s + 2, 2.0) for s in range(10, 400, 3)]}
    p = write_bigwig(str(tmp_path / "o.bw"), [("chr22", 10_000)], iv, items_per_block=2, fanout=2)
    region = RegionSpec("22", 4000, 4500)
    files = spark.createDataFrame([(p,)], "file_path string")
    got = [(r.start, r.end) for r in convert_intervals(scan_bigwig(files, region), region).collect()]
    assert got == [(1, 5000)]


@settings(max_examples=4, deadline=None)
@given(tracks(), st.booleans(), st.integers(1, 20))
def test_converted_output_passes_validation(spark, tmp_path_factory, track, compressed, per_block):
    """Whatever the input, a published table passes every check of the
    validator (scores here are never NaN, so no NULLs are produced)."""
    from covtab.operators.validate import validate_dataset
    from covtab.plans.jobs import convert_directory
    from covtab.operators.convert import EmptyResultError
    chroms, iv, kinds = track
    d = tmp_path_factory.mktemp("bw")
    for i in range(2):
        write_bigwig(str(d / f"s{i}.bw"), [(c, 10_000_000) for c in chroms], iv,
                     kind={c: kinds.get(c, 1) for c in chroms}, compressed=compressed,
                     items_per_block=per_block)
    out = str(tmp_path_factory.mktemp("out") / "t")
    try:
        convert_directory(spark, str(d), out, num_partitions=3)
    except EmptyResultError:
        return
    statuses = {r.check: r.status for r in validate_dataset(spark, out).collect()}
    assert all(v in ("OK", "INFO", "SKIP") for v in statuses.values()), statuses
