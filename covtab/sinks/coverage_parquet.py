"""Sorted coverage Parquet (K1) with one table per (study, group) (K2).

Layout: ``<output>/region=<r>/study_name=<s>/qtl_group=<g>/chrom_rank=<nnnn>/part-*``.
A chromosome's rows have files of their own, so a region query opens no other
chromosome's files, and tables of different regions live side by side.

Plan: ONE shuffle into ranges of (study, group, chromosome rank, start), then a
local sort that adds (end, sample_id) as tie-breakers, then a partitioned
write. The ranges come from the inputs' own indexes where there are any
(``covtab.sinks.bounds``), else from Spark's sample of the sort keys. Either way
a (study, group) or chromosome holding a third of all rows is split over many
tasks by start; no task ever holds a whole group. Each task writes a contiguous
key range, so the files of a chromosome are ordered by their part number and
row groups carry tight min/max statistics on start/end for region queries (J8).

The tables are written aside, with an index of their files, and put in place by
renames (``covtab.sinks.publication``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covtab import paths
from covtab.functions.chrom import order_rank
from covtab.region import RegionSpec, region_root
from covtab.schema import (COVERAGE_SCHEMA, GROUP_COLUMNS, OUTPUT_COLUMNS,
                           PARTITIONED_COVERAGE_SCHEMA)
from covtab.sinks.bounds import RangeBounds
from covtab.sinks.file_index import write_index
from covtab.sinks.publication import (finish_publications, new_publication, publish, table_paths,
                                      tables_of)

RANK_COL = "chrom_rank"


def sort_keys(group_cols: list[str] = GROUP_COLUMNS) -> list[str]:
    # the full order, so rows tied on start (one bin in many samples) can
    # still be split between tasks by the range partitioner
    return [*group_cols, RANK_COL, "start", "end", "sample_id"]


def _ranked(df: DataFrame, num_partitions: int | None, group_cols: list[str],
            bounds: RangeBounds | None = None) -> DataFrame:
    keys = sort_keys(group_cols)
    # four digits, so that path order is chromosome order
    rank = F.lpad(order_rank("seqnames").cast("string"), 4, "0")
    if bounds is not None and num_partitions:
        dealt = bounds.deal(df, num_partitions).withColumn(RANK_COL, rank)
    else:
        df = df.withColumn(RANK_COL, rank)
        dealt = (df.repartitionByRange(num_partitions, *keys) if num_partitions
                 else df.repartitionByRange(*keys))
    return dealt.sortWithinPartitions(*keys)


def sorted_for_publish(df: DataFrame, num_partitions: int | None = None,
                       group_cols: list[str] = GROUP_COLUMNS) -> DataFrame:
    """O1/K1 ordering: chromosome list order (1..22, then X), then start;
    ties broken by end and sample_id (a legal refinement of the original
    'ORDER BY start'). Without ``num_partitions`` Spark sizes the ranges."""
    return _ranked(df, num_partitions, group_cols).drop(RANK_COL)


def write_coverage(df: DataFrame, out: str, region: RegionSpec | None = None,
                   num_partitions: int | None = None, group_cols: list[str] = GROUP_COLUMNS,
                   max_records_per_file: int | None = None, row_group_bytes: int | None = None,
                   bounds: RangeBounds | None = None, empty: DataFrame | None = None) -> str:
    """K1+K2: publish the tables of one region below ``out``, each in D1 column
    order with rows in order; returns the region's root. Only (study, group)
    tables that ``df`` holds are replaced, each as a whole. ``empty`` names
    groups that get a table without rows."""
    spark, region = df.sparkSession, region or RegionSpec()
    finish_publications(spark, out, region)
    publication = new_publication(out, region)
    tables = tables_of(publication)
    ordered = _ranked(df, num_partitions, group_cols, bounds)
    w = ordered.select(*OUTPUT_COLUMNS, *group_cols, RANK_COL).write
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if row_group_bytes:
        # smaller row groups = finer min/max pruning for region queries
        w = w.option("parquet.block.size", int(row_group_bytes))
    w.partitionBy(*group_cols, RANK_COL).parquet(tables)
    if empty is not None:
        _add_empty_tables(empty.select(*group_cols), tables, f"{publication}/empty")
    depth = len(group_cols)
    write_index(spark, tables, f"{publication}/index", group_cols,
                table_paths(spark, tables, depth))
    publish(spark, publication, out, region, depth)
    return region_root(out, region)


def _add_empty_tables(groups: DataFrame, tables: str, scratch: str) -> None:
    """A table of schema D1 without rows for each group. One job writes its
    file; every other table gets a copy."""
    spark = groups.sparkSession
    spark.createDataFrame([], COVERAGE_SCHEMA).coalesce(1).write.parquet(scratch)
    file, = (x for x in paths.children(spark, scratch) if x.endswith(".parquet"))
    for r in groups.toLocalIterator():
        table = "/".join([tables, *[f"{c}={_escaped(r[c])}" for c in groups.columns]])
        paths.copy(spark, f"{scratch}/{file}", f"{table}/{RANK_COL}=0000/part-00000.parquet")
    paths.delete(spark, scratch)


# The characters Spark writes as %XX in a partition directory.
_SPECIAL = set('"#%\'*/:=?\\{[]^\x7f') | {chr(c) for c in range(1, 32)}


def _escaped(value: str | None) -> str:
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if c in _SPECIAL else c for c in value)


def table_directory(study: str | None, group: str | None) -> str:
    """A glob for the tables of a study and group, relative to the region's
    root; None stands for any."""
    names = [f"{c}=*" if v is None else f"{c}={paths.glob_safe(_escaped(v))}"
             for c, v in zip(GROUP_COLUMNS, (study, group), strict=True)]
    return "/".join(names)


def read_coverage(spark: SparkSession, root: str, keep_rank: bool = False,
                  files: list[str] | None = None) -> DataFrame:
    """Read a region's tables; the (study, group) keys stay strings, and the
    layout's chromosome rank is left out unless asked for. ``files`` (paths
    from ``root``) limits the read to those."""
    grouped = any(x.startswith(f"{GROUP_COLUMNS[0]}=") for x in paths.children(
        spark, root))
    fields = (PARTITIONED_COVERAGE_SCHEMA if grouped else COVERAGE_SCHEMA).fields
    schema = T.StructType([*fields, T.StructField(RANK_COL, T.StringType())])
    reader = spark.read.schema(schema)
    if files is None:
        df = reader.parquet(root)
    elif files:
        df = reader.option("basePath", root).parquet(*[f"{root}/{x}" for x in files])
    else:
        df = spark.createDataFrame([], schema)
    return df if keep_rank else df.drop(RANK_COL)


def register_table(spark: SparkSession, root: str, name: str = "parq") -> DataFrame:
    """A published table (or dataset) as a temporary view for SQL."""
    df = read_coverage(spark, root)
    df.createOrReplaceTempView(name)
    return df
