"""Projections of the driver's tables into the coverage data model.

The driver tables hold no coverage data, so ``lineitem`` stands in for decoded
BigWig intervals (D2), ``orders`` for a table's physical row sequence and
``customer`` x ``nation`` x ``region`` for a directory tree / manifest. Every expression here is plain
DataFrame code, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def lineitem_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw intervals (D2) from lineitem: 60 sample files over 6 (study, group)
    pairs, mixed 'chr'/bare names, zero-length intervals and NaN scores."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice")
    supp, part, line = F.col("l_suppkey"), F.col("l_partkey"), F.col("l_linenumber")
    even_line = (line % 2) == 0
    pc = part % 26
    chrom = (F.when(pc == 0, F.lit("chrX"))
              .when(pc == 23, F.lit("chrY"))
              .when(pc == 24, F.lit("chrM"))
              .when(pc == 25, F.lit("GL000219.1"))
              .otherwise(F.concat(F.when(even_line, F.lit("chr")).otherwise(F.lit("")), _s(pc))))
    pos = ((F.col("l_orderkey") * 97 + line * 13) % 50000000).cast("int")
    file_path = F.concat(
        F.lit("/cov/study_"), _s(supp % 3), F.lit("/grp_"), _s(supp % 2),
        F.lit("/bigwig/S"), _s(supp % 10), F.lit(".rep"), _s(line % 2),
        F.when(even_line, F.lit(".bw")).otherwise(F.lit(".bigwig")))
    return li.select(
        F.concat(F.lit("study_"), _s(supp % 3)).alias("study_name"),
        F.concat(F.lit("grp_"), _s(supp % 2)).alias("qtl_group"),
        file_path.alias("file_path"),
        chrom.alias("chrom"),
        pos.alias("start0"),
        (pos + F.col("l_quantity").cast("int") - 1).alias("end0"),
        F.when(part % 97 == 0, F.lit(float("nan"))).otherwise(F.col("l_extendedprice"))
         .alias("score"),
    )


def orders_row_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A physical row sequence for the row-order check: o_orderkey is the
    0-based row index of one 'file', o_custkey % 23 the chromosome name and
    the floor of o_totalprice the start."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.lit("orders").alias("file_path"),
        F.col("o_orderkey").alias("row_index"),
        _s(F.col("o_custkey") % 23).alias("seqnames"),
        F.floor("o_totalprice").cast("int").alias("start"),
    )


def _customers_with_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, F.col("n_regionkey") == r.r_regionkey))


def customer_dirs(spark: SparkSession, sf_dir: str, root: str = "/cov") -> DataFrame:
    """Candidate directories, one per customer (so the tree grows with the
    data): '<root>/<region>/<customer>/bigwig' for most market segments;
    BUILDING customers end in 'other' (wrong leaf) and MACHINERY customers
    sit one level deeper under their nation (wrong depth) — discovery must
    reject both."""
    j = _customers_with_region(spark, sf_dir)
    seg = F.col("c_mktsegment")
    path = (F.when(seg == "BUILDING", F.concat_ws("/", F.lit(root), "r_name", "c_name", F.lit("other")))
             .when(seg == "MACHINERY",
                   F.concat_ws("/", F.lit(root), "r_name", "n_name", "c_name", F.lit("bigwig")))
             .otherwise(F.concat_ws("/", F.lit(root), "r_name", "c_name", F.lit("bigwig"))))
    return j.select(path.alias("path"))


def customer_manifest(spark: SparkSession, sf_dir: str, root: str = "/cov") -> DataFrame:
    """A manifest (D4) with one row per customer: study = region, group =
    customer name."""
    j = _customers_with_region(spark, sf_dir)
    return j.select(
        F.col("r_name").alias("study_name"),
        F.col("c_name").alias("qtl_group"),
        F.concat_ws("/", F.lit(root), "r_name", "c_name", F.lit("bigwig")).alias("bigwig_dir"),
    )


# Fixed value: chromosome length written into fixture BigWigs (longer than
# any fixture position, so range ends are never clamped by it).
FIXTURE_CHROM_SIZE = 250_000_000


ENCODE_ROWS = 200_000  # rows that one encoded file holds at most


def encode_lineitem_bigwigs(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The lineitem intervals as real BigWig files under ``root``."""
    return encode_bigwigs(lineitem_intervals(spark, sf_dir), root)


def encode_bigwigs(raw: DataFrame, root: str) -> DataFrame:
    """Write raw intervals (D2) as real BigWig files under ``root``.

    Every scan task writes, for each sample file it holds rows of in a bounded
    run of ``ENCODE_ROWS`` rows, one BigWig
    '<root><dir>/<name>.t<partition>-<run>.<ext>' (sample id unchanged: the name
    before its first dot). Work per task is bounded by the run; no file's rows
    are gathered into one task. Returns a small per-file DataFrame (path, rows)
    — an action runs it."""
    import os

    import pandas as pd
    from pyspark import TaskContext

    from covtab.paths import is_uri, plain
    from covtab.testing.bigwig_writer import write_bigwig

    raw = raw.select("file_path", "chrom", "start0", "end0", "score")
    root = plain(root)

    def write_file(path: str, rows: pd.DataFrame, mark: str) -> tuple[str, int]:
        d, base = os.path.split(path)
        name, ext = base.rsplit(".", 1)
        target = f"{root}{d}/{name}.t{mark}.{ext}"
        rows = rows.sort_values(["chrom", "start0", "end0"], kind="stable")
        iv = {c: list(zip(g["start0"].tolist(), g["end0"].tolist(), g["score"].tolist()))
              for c, g in rows.groupby("chrom", sort=True)}
        sizes = [(c, FIXTURE_CHROM_SIZE) for c in iv]
        if is_uri(target):
            # shared object store / HDFS: one PUT, a retry overwrites it
            write_bigwig(target, sizes, iv)
        else:
            os.makedirs(os.path.dirname(target), exist_ok=True)
            tmp = target + ".tmp"
            write_bigwig(tmp, sizes, iv)
            os.replace(tmp, target)      # a retried task rewrites atomically
        return target, len(rows)

    def write(batches):
        part, run, held, n = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            pdf = pd.concat(held, ignore_index=True)
            return pd.DataFrame([write_file(path, rows, f"{part:05d}-{run:05d}")
                                 for path, rows in pdf.groupby("file_path", sort=True)],
                                columns=["path", "rows"])
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= ENCODE_ROWS:
                yield flush()
                run, held, n = run + 1, [], 0
        if n:
            yield flush()

    return raw.mapInPandas(write, "path string, rows long")


def add_broken_files(files: DataFrame, every: int = 5) -> DataFrame:
    """The same file rows, with the paths of samples whose number ``every``
    divides replaced by those of files that cannot be read: they do not exist."""
    number = F.regexp_extract(F.substring_index("file_path", "/", -1), r"^S(\d+)\.", 1)
    broken = number.cast("int") % every == 0
    return files.withColumn("file_path", F.when(broken, F.concat(
        "file_path", F.lit(".missing"))).otherwise(F.col("file_path")))


def mixed_name_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineitem intervals all on chromosome 1, which a file knows by two
    names: 'chr1' for even lines, '1' for odd ones, and both for every third
    start. Both replicates of a sample share one file."""
    raw = lineitem_intervals(spark, sf_dir)
    even = F.col("file_path").endswith(".bw")
    names = F.when(F.col("start0") % 3 == 0, F.array(F.lit("chr1"), F.lit("1"))).otherwise(
        F.array(F.when(even, F.lit("chr1")).otherwise(F.lit("1"))))
    return raw.select("study_name", "qtl_group",
                      F.regexp_replace("file_path", r"\.rep[01]\.[a-z]+$", ".bw").alias("file_path"),
                      F.explode(names).alias("chrom"), "start0", "end0", "score")


# How the files of some samples are damaged, by the sample file's name.
DAMAGED = {"S3.rep0.bw": "index", "S5.rep1.bigwig": "block", "S7.rep0.bw": "range"}


def damage_files(files: DataFrame) -> DataFrame:
    """Damage every listed part of the samples in ``DAMAGED``. Returns a row for
    each damaged file; an action runs it."""
    import re

    import pandas as pd

    from covtab.testing.bigwig_writer import damage_bigwig

    def run(batches):
        for pdf in batches:
            hit = []
            for path in pdf["file_path"]:
                name = re.sub(r"\.t[0-9-]{11}\.", ".", path.rsplit("/", 1)[1])
                if name in DAMAGED:
                    damage_bigwig(path, DAMAGED[name])
                    hit.append((path, DAMAGED[name]))
            yield pd.DataFrame(hit, columns=["file_path", "kind"])
    return files.select("file_path").mapInPandas(run, "file_path string, kind string")


def customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested tree of one coverage file for each customer: those of ASIA all
    in one directory, the others by nation and market segment. Every seventh
    customer's file is no BigWig."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                     "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    directory = F.when(F.col("r_name") == "ASIA", F.lit("ASIA")).otherwise(
        F.concat_ws("/", "r_name", "n_name", "c_mktsegment"))
    return j.select(F.concat_ws("/", directory, F.concat("c_name", F.lit(".bw"))).alias("file"),
                    (F.col("c_custkey") % 7 == 0).alias("broken"),
                    (F.col("c_custkey") % 5 + 1).cast("int").alias("n_chroms"))


def write_customer_files(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Write ``customer_files`` below ``root``, each task its own. Returns a row
    for each file; an action runs it."""
    import os

    import pandas as pd

    from covtab.paths import plain
    from covtab.testing.bigwig_writer import write_bigwig

    root = plain(root)

    def run(batches):
        for pdf in batches:
            for file, broken, n in zip(pdf["file"], pdf["broken"], pdf["n_chroms"]):
                path = f"{root}/{file}"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                if broken:
                    with open(path, "w") as f:
                        f.write("no coverage here, but as long as a header is\n" * 3)
                else:
                    chroms = [f"chr{k + 1}" for k in range(int(n))]
                    write_bigwig(path, [(c, 1000) for c in chroms], {c: [(0, 5, 1.0)] for c in chroms})
            yield pdf[["file"]]
    files = customer_files(spark, sf_dir)
    return files.repartition(max(1, spark.sparkContext.defaultParallelism)).mapInPandas(
        run, "file string")


def touch_files(files: DataFrame) -> DataFrame:
    """Give every listed file another time of change. Returns a row for each; an
    action runs it."""
    import os

    def run(batches):
        for pdf in batches:
            for path in pdf["file_path"]:
                os.utime(path, ns=(1_000_000_000, 1_000_000_000))
            yield pdf[["file_path"]]
    return files.select("file_path").mapInPandas(run, "file_path string")
