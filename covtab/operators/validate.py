"""Output-table validation (J6): integrity counts (A6-A9, A11-A14),
per-chromosome counts (A10), the NA report (A15), the schema of every published
file (W2), row order (W1) and the assembled report (D8). Every function
validates all (study, group) tables of a DataFrame at once; pass
``group_cols=[]`` for a single table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covtab import paths
from covtab.functions.chrom import count_rank
from covtab.operators.order_check import check_row_order
from covtab.region import Expectation
from covtab.schema import COVERAGE_SCHEMA, GROUP_COLUMNS, OUTPUT_COLUMNS, STRAND, schema_problems
from covtab.session import checkpoint_dir


def _any_null(cols) -> F.Column:
    cond = None
    for c in cols:
        e = F.col(c).isNull()
        cond = e if cond is None else cond | e
    return cond


def integrity_counts(df: DataFrame, expect: Expectation | None = None,
                     group_cols: list[str] = GROUP_COLUMNS) -> DataFrame:
    """A6-A9, A11-A14 as ONE aggregate: row count, rows with a NULL (NaN is not
    NULL here), invalid intervals, bad strand, rows off the expected chromosome
    or outside the expected bounds, and the exact number of samples.
    Checks without an expectation come out NULL."""
    expect = expect or Expectation()
    none = F.lit(None).cast("long")
    aggs = [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(_any_null(OUTPUT_COLUMNS)).alias("null_rows"),
        F.count_if((F.col("start") < 1) | (F.col("end") < F.col("start"))).alias("bad_intervals"),
        F.count_if(F.col("strand") != F.lit(STRAND)).alias("bad_strand"),
        (F.count_if(F.col("seqnames") != F.lit(expect.chrom)) if expect.chrom is not None
         else none).alias("off_chrom"),
        (F.count_if(F.col("end") < F.lit(expect.pos_start)) if expect.pos_start is not None
         else none).alias("end_before_start_bound"),
        (F.count_if(F.col("start") > F.lit(expect.pos_end)) if expect.pos_end is not None
         else none).alias("start_after_end_bound"),
        F.count_distinct("sample_id").alias("n_samples"),
    ]
    if group_cols:
        return df.groupBy(*group_cols).agg(*aggs)
    return df.agg(*aggs)


def chrom_counts(df: DataFrame, group_cols: list[str] = GROUP_COLUMNS) -> DataFrame:
    """A10: rows per chromosome with the count-ordering rank (P7). Order by
    (rank, seqnames) to print; the order is not forced here."""
    return (df.groupBy(*group_cols, "seqnames")
              .agg(F.count(F.lit(1)).alias("n"))
              .withColumn("chrom_rank", count_rank("seqnames")))


def na_report(df: DataFrame, group_cols: list[str] = GROUP_COLUMNS,
              columns: list[str] = OUTPUT_COLUMNS) -> DataFrame:
    """Per-column NA counts (NULL, or NaN for floating columns), the
    table's total rows, and whether the column has any NA. One aggregate pass,
    unpivoted to one row per column."""
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    for i, c in enumerate(columns):
        isna = F.col(c).isNull()
        if types[c] in ("double", "float"):
            isna = isna | F.isnan(c)
        aggs.append(F.count_if(isna).alias(f"na_{i}"))
    wide = df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)
    pairs = ", ".join(f"'{c}', na_{i}" for i, c in enumerate(columns))
    long = wide.select(*group_cols, "total_rows",
                       F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, na_count)"))
    return long.select(*group_cols, "column_name", "na_count", "total_rows",
                       (F.col("na_count") > 0).alias("has_na"))


# ------------------------------------------------------------------ J6 report

def _profile(rows: DataFrame, expect: Expectation, g: list[str]) -> DataFrame:
    """The one pass over the rows: counts by (table, chromosome, sample),
    combined on the map side."""
    c = F.col
    no = F.lit(0).cast("long")
    return rows.groupBy(*g, "seqnames", "sample_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(_any_null(OUTPUT_COLUMNS)).alias("null_rows"),
        F.count_if((c("start") < 1) | (c("end") < c("start"))).alias("bad_intervals"),
        F.count_if(c("strand") != F.lit(STRAND)).alias("bad_strand"),
        (F.count_if(c("end") < F.lit(expect.pos_start)) if expect.pos_start is not None
         else no).alias("end_before"),
        (F.count_if(c("start") > F.lit(expect.pos_end)) if expect.pos_end is not None
         else no).alias("start_after"))


def _table_counts(profile: DataFrame, expect: Expectation, g: list[str]) -> DataFrame:
    """One row per table. Samples are counted in two steps, never gathered."""
    c = F.col
    none = F.lit(None).cast("long")

    def total(col):
        return F.coalesce(F.sum(col), F.lit(0).cast("long"))
    counts = (profile.groupBy(*g) if g else profile).agg(
        total("n").alias("row_count"), total("null_rows").alias("null_rows"),
        total("bad_intervals").alias("bad_intervals"), total("bad_strand").alias("bad_strand"),
        (total(F.when(c("seqnames") != F.lit(expect.chrom), c("n")))
         if expect.chrom is not None else none).alias("off_chrom"),
        (total("end_before") if expect.pos_start is not None else none).alias("before_bound"),
        (total("start_after") if expect.pos_end is not None else none).alias("after_bound"))
    each = profile.filter(c("sample_id").isNotNull()).groupBy(*g, "sample_id").agg(
        F.lit(1).alias("one"))
    samples = (each.groupBy(*g) if g else each).agg(F.count("*").alias("n_samples"))
    return _one_table(counts, g).join(_one_table(samples, g), g or ["_table"], "left").withColumn(
        "n_samples", F.coalesce("n_samples", F.lit(0).cast("long")))


def _one_table(rows: DataFrame, g: list[str]) -> DataFrame:
    """Without group columns, a constant key: joins stay equi-joins, and the
    global aggregates still report an empty table."""
    return rows if g else rows.withColumn("_table", F.lit(""))


class ValidationError(AssertionError):
    pass


CHECKS = ["schema", "row_count", "no_nulls", "valid_intervals", "strand", "chromosomes",
          "expected_chrom", "expected_pos_start", "expected_pos_end", "samples", "row_order"]
SCHEMA_OK = "every file has the columns and types of the coverage table"


def validation_report(rows: DataFrame, expect: Expectation | None = None,
                      group_cols: list[str] = GROUP_COLUMNS) -> DataFrame:
    """J6 as a DataFrame: for every table, the checks in the order of
    ``CHECKS`` with status OK / INFO / FAIL / SKIP; ``chromosomes`` has a row
    for each chromosome. ``rows`` must carry file_path and row_index. Two
    passes over the rows: the profile and the row order."""
    expect = expect or Expectation()
    g = list(group_cols)
    profile = _profile(rows, expect, g).persist(StorageLevel.MEMORY_AND_DISK)
    counts = _table_counts(profile, expect, g)
    order = check_row_order(rows, g)
    t = counts.join(_one_table(order, g), g or ["_table"], "left")
    c, none = F.col, F.lit(None).cast("long")
    in_order_text = F.concat(F.lit("in order over "), c("rows_checked").cast("string"),
                             F.lit(" rows"))
    broken = F.concat(F.lit("the "), c("first_bad_kind"), F.lit(" falls first at row "),
                      c("first_bad_row").cast("string"))
    entries = {
        "schema": (F.lit(0).cast("long"), F.lit(SCHEMA_OK)),
        "row_count": (F.when(c("row_count") > 0, 0).otherwise(1).cast("long"),
                      F.concat(c("row_count").cast("string"), F.lit(" rows"))),
        "no_nulls": (c("null_rows"), F.lit("rows with a NULL")),
        "valid_intervals": (c("bad_intervals"), F.lit("rows that start before 1 or end too early")),
        "strand": (c("bad_strand"), F.lit("rows on another strand than *")),
        "expected_chrom": (c("off_chrom"), F.lit(f"rows off chromosome {expect.chrom}")),
        "expected_pos_start": (c("before_bound"), F.lit(f"rows ending before {expect.pos_start}")),
        "expected_pos_end": (c("after_bound"), F.lit(f"rows starting after {expect.pos_end}")),
        "samples": (none, F.concat(c("n_samples").cast("string"), F.lit(" samples"))),
        "row_order": (c("rank_decreases") + c("start_decreases"),
                      F.when(c("ok"), in_order_text).otherwise(broken)),
    }
    structs = [F.struct(F.lit(CHECKS.index(name) + 1).alias("seq"), F.lit(name).alias("check"),
                        _status(name, bad).alias("status"), bad.alias("n_bad"),
                        detail.alias("detail")) for name, (bad, detail) in entries.items()]
    checks = t.select(*g, F.explode(F.array(*structs)).alias("r")).select(*g, "r.*")
    chroms = profile.groupBy(*g, "seqnames").agg(F.sum("n").alias("n")).select(
        *g, F.lit(CHECKS.index("chromosomes") + 1).alias("seq"),
        F.lit("chromosomes").alias("check"), F.lit("INFO").alias("status"), none.alias("n_bad"),
        F.concat(F.coalesce("seqnames", F.lit("NULL")), F.lit(":"), c("n").cast("string"))
        .alias("detail"))
    return checks.unionByName(chroms)


def _status(name: str, bad: F.Column) -> F.Column:
    if name == "samples":
        return F.lit("INFO")
    return F.when(bad.isNull(), F.lit("SKIP")).when(bad > 0, F.lit("FAIL")).otherwise(F.lit("OK"))


# Fixed value: the directory name that Spark gives a NULL key.
NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"


def physical_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a published table or dataset with their physical position:
    the group columns it has, file and 0-based row index."""
    grouped = any(x.startswith(f"{GROUP_COLUMNS[0]}=") for x in paths.children(spark, path))
    fields = [*COVERAGE_SCHEMA.fields,
              *[T.StructField(c, T.StringType()) for c in GROUP_COLUMNS if grouped]]
    df = spark.read.schema(T.StructType(fields)).parquet(path)
    return df.select(*[f.name for f in fields], F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.row_index").alias("row_index"))


def table_of_file(path: str) -> list[F.Column]:
    """The group columns of a published file, from the names of its directories."""
    out = []
    for c in GROUP_COLUMNS:
        name = F.regexp_extract(path, f"/{c}=([^/]*)/", 1)
        # '+' would become a space when the percent signs are decoded
        value = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
        out.append(F.when(name != NULL_DIRECTORY, value).alias(c))
    return out


# The column types of the coverage table as Parquet readers name them.
_ARROW_TYPES = {"string": T.StringType(), "large_string": T.StringType(),
                "int32": T.IntegerType(), "int64": T.LongType(), "double": T.DoubleType(),
                "float": T.FloatType()}


def _footer_problems(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    from covtab.sources.bigwig import open_file
    for pdf in batches:
        out = []
        for path in pdf["file_path"]:
            with open_file(path) as f:
                found = pq.read_schema(f)
            schema = T.StructType([T.StructField(x.name, _ARROW_TYPES.get(str(x.type), T.NullType()))
                                   for x in found])
            problems = schema_problems(schema)
            if problems:
                out.append((path, "; ".join(problems)))
        yield pd.DataFrame(out, columns=["file_path", "problem"])


def footer_problems(spark: SparkSession, path: str) -> DataFrame:
    """``file_path``, ``problem`` of every published file whose footer has
    other columns, another order or other types; read by the executors."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(path)
             .select(paths.from_listing("path").alias("file_path")))
    return (files.repartition(max(1, spark.sparkContext.defaultParallelism))
            .mapInPandas(_footer_problems, "file_path string, problem string"))


def _key(cols: list[F.Column]) -> F.Column:
    """The group columns as one string that only equal values share."""
    return F.concat(*[F.when(c.isNull(), F.lit("-")).otherwise(
        F.concat(F.length(c).cast("string"), F.lit(":"), c)) for c in cols])


def _schema_failures(wrong: DataFrame, g: list[str]) -> DataFrame:
    """The report of the tables that hold a file of another schema: a FAIL for
    each such file, and every other check SKIPped."""
    def row(seq, check, status, n_bad, detail):
        return F.struct(seq.cast("int").alias("seq"), check.alias("check"),
                        F.lit(status).alias("status"), n_bad.cast("long").alias("n_bad"),
                        detail.cast("string").alias("detail"))
    none = F.lit(None)
    files = wrong.select(*g, row(F.lit(1), F.lit(CHECKS[0]), "FAIL", F.lit(1),
                                 F.concat_ws(": ", "file_path", "problem")).alias("r"))
    others = F.array(*[row(F.lit(k + 1), F.lit(name), "SKIP", none, none)
                       for k, name in enumerate(CHECKS) if k])
    tables = (wrong.select(*g).distinct() if g else wrong.limit(1)).select(
        *g, F.explode(others).alias("r"))
    return files.unionByName(tables).select(*g, "r.*")


def validate_dataset(spark: SparkSession, path: str, expect: Expectation | None = None,
                     raise_on_fail: bool = False) -> DataFrame:
    """J6 on a written dataset: one table (part files or chromosome directories
    under ``path``) or a region's root with (study, group) directories. A table
    with a file of another schema has a FAIL for each such file and no other
    verdict, since its rows cannot be read as coverage; all other tables have
    their whole report."""
    path = paths.absolute(path)
    rows = physical_rows(spark, path)
    g = [c for c in GROUP_COLUMNS if c in rows.columns]
    wrong = footer_problems(spark, path)
    if g:
        wrong = wrong.select("*", *table_of_file("file_path"))
    checkpoint_dir(spark)
    wrong = wrong.checkpoint(eager=True)
    bad = ([r[0] for r in wrong.select(_key([F.col(c) for c in g])).distinct().collect()] if g
           else wrong.limit(1).collect())
    if not bad:
        report = validation_report(rows, expect, g)
    else:
        report = _schema_failures(wrong, g)
        if g:  # a filter on the directories: files of bad tables are not opened
            sound = rows.where(~_key([F.col(c) for c in g]).isin(bad))
            report = report.unionByName(validation_report(sound, expect, g))
    if raise_on_fail:
        fails = report.filter(F.col("status") == "FAIL").orderBy("seq", *g).limit(1).collect()
        if fails:
            r = fails[0]
            raise ValidationError(f"{r['check']}: {r['n_bad']} bad - {r['detail']}")
    return report
