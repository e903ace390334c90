"""The index of a published table's files.

Rows are sorted by start, but one long interval makes ``end >= position`` true
for row groups and files far before it, and a scan has to open every file of a
chromosome to find out. So each table holds, in ``_files`` beside its
chromosomes, one row for each data file: chromosome rank, rows, least and
greatest start, greatest end and the greatest end up to and with that file.
They come from the Parquet footers, read by the executors when the table is
published, and move into place with it. A region query picks files by them and
opens no other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from covtab import paths

INDEX_NAME = "_files"
INDEX_SCHEMA = ("chrom_rank string, file string, n_rows long, min_start long, max_start long, "
                "max_end long, running_max_end long")
# Fixed value: the directory name that Spark gives a null key.
_NULL_KEY = "__HIVE_DEFAULT_PARTITION__"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _key(path: str, name: str) -> str | None:
    value = re.search(f"/{name}=([^/]*)/", path)[1]
    return None if value == _NULL_KEY else unquote(value)


def _read_footers(group_cols: list[str], names: list[str]):
    keys = [*group_cols, "chrom_rank"]
    inside = re.compile("".join(f"{k}=[^/]*/" for k in keys) + "[^/]*$")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        from covtab.sources.bigwig import open_file
        for pdf in batches:
            out = []
            for path in pdf["file_path"]:
                with open_file(path) as f:
                    footer = pq.read_metadata(f)
                column = {footer.schema.column(k).name: k for k in range(footer.num_columns)}
                starts, ends = ([footer.row_group(g).column(column[c]).statistics
                                 for g in range(footer.num_row_groups)] for c in ("start", "end"))
                bounds = (None, None, None)  # the file takes part in every query
                if starts and all(s is not None and s.has_min_max for s in [*starts, *ends]):
                    bounds = (min(s.min for s in starts), max(s.max for s in starts),
                              max(s.max for s in ends))
                out.append((*[_key(path, k) for k in keys], inside.search(path)[0],
                            footer.num_rows, *bounds))
            yield pd.DataFrame(out, columns=names).astype(
                {c: "Int64" for c in names[len(keys) + 1:]})
    return run


def _part_number() -> F.Column:
    return F.regexp_extract("file", r"/part-(\d+)[^/]*$", 1).try_cast("long")


def index_files(spark: SparkSession, tables: str, group_cols: list[str]) -> DataFrame:
    """``group_cols`` and a row for each data file below ``tables``; ``file``
    is its path from there."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet").load(tables)
              .select(paths.from_listing("path").alias("file_path")))
    schema = ", ".join([*[f"{c} string" for c in group_cols],
                        *INDEX_SCHEMA.split(", ")[:-1]])
    rows = (listed.repartition(max(1, spark.sparkContext.defaultParallelism))
            .mapInPandas(_read_footers(list(group_cols), _names(schema)), schema))
    before = (Window.partitionBy(*group_cols, "chrom_rank")
              .orderBy(_part_number(), "file").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("running_max_end", F.max("max_end").over(before))


def write_index(spark: SparkSession, tables: str, scratch: str, group_cols: list[str],
                relative: list[str]) -> None:
    """Put its index into every one of the tables at ``relative`` below
    ``tables``; ``scratch`` is a free path on the same file system."""
    rows = index_files(spark, tables, group_cols)
    order = ["chrom_rank", _part_number(), "file"]
    if group_cols:
        rows = rows.repartition(*group_cols).sortWithinPartitions(*group_cols, *order)
    else:
        rows = rows.orderBy(*order).coalesce(1)
    writer = rows.select(*_names(INDEX_SCHEMA), *group_cols).write
    (writer.partitionBy(*group_cols) if group_cols else writer).parquet(scratch)
    for table in relative:
        paths.rename(spark, f"{scratch}/{table}".rstrip("/"),
                     f"{tables}/{table}".rstrip("/") + f"/{INDEX_NAME}")
    paths.delete(spark, scratch)


def read_index(spark: SparkSession, tables: list[str]) -> DataFrame:
    """The indexes of the tables at the given paths."""
    return spark.read.schema(INDEX_SCHEMA).parquet(*[f"{t}/{INDEX_NAME}" for t in tables])


def overlapping(index: DataFrame, ranks: list[int], start: int | None, end: int | None
                ) -> DataFrame:
    """Rows of the files that can hold an interval of the chromosomes and
    bounds. Where not even the running end reaches ``start``, no file so far
    does."""
    keep = F.col("chrom_rank").cast("int").isin(ranks)
    if start is not None:
        keep = keep & F.coalesce((F.col("running_max_end") >= start)
                                 & (F.col("max_end") >= start), F.lit(True))
    if end is not None:
        keep = keep & F.coalesce(F.col("min_start") <= end, F.lit(True))
    return index.where(keep)
