"""``spark.read.format("bigwig")`` — the BigWig scan as a Python data source.

    register_bigwig_source(spark)
    df = (spark.read.format("bigwig")
          .option("recursive", "false").option("chunkBytes", str(64 << 20))
          .load("/shared/study/group/bigwig"))
    df.filter("chrom = 'chr22' AND start0 < 20000000 AND end0 >= 18500000")

Columns: file_path, chrom, start0, end0 (0-based half-open), score.
Filters on ``chrom`` (=, IN) are applied exactly inside the source; bounds on
``start0`` (<, <=) and ``end0`` (>, >=) prune whole blocks through the file's
R-tree and are re-checked by Spark.

A task is a range of ``chunkBytes`` bytes of a file, as for any splittable
format: planning lists names and sizes and opens no file. A task reads the
file's header, chromosome tree and the R-tree nodes that the filters leave, and
decodes the blocks that begin in its range. So one chromosome of one large file
is spread over many tasks, and every index is read by executors.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, LessThan,
                                    LessThanOrEqual)

SOURCE_SCHEMA = "file_path string, chrom string, start0 long, end0 long, score double"


class _FileRange(InputPartition):
    """One task: the blocks that begin in a range of a file's bytes."""

    def __init__(self, path: str | None, lo: int = 0, hi: int = 0):
        self.path, self.lo, self.hi = path, lo, hi


class BigWigReader(DataSourceReader):
    def __init__(self, options):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("bigwig source needs a path (file or directory)")
        self.recursive = str(options.get("recursive", "false")).lower() == "true"
        self.chunk_bytes = int(options.get("chunkBytes", str(64 << 20)))
        self.chroms: set[str] | None = None
        self.lo: int | None = None      # rows need end0 >= lo
        self.hi: int | None = None      # rows need start0 < hi

    def pushFilters(self, filters):
        for f in filters:
            col = f.attribute[0] if getattr(f, "attribute", None) else None
            if col == "chrom" and isinstance(f, EqualTo):
                self.chroms = {f.value} if self.chroms is None else self.chroms & {f.value}
                continue
            if col == "chrom" and isinstance(f, In):
                vals = set(f.value)
                self.chroms = vals if self.chroms is None else self.chroms & vals
                continue
            if col == "end0" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                lo = int(f.value) + (1 if isinstance(f, GreaterThan) else 0)
                self.lo = lo if self.lo is None else max(self.lo, lo)
            elif col == "start0" and isinstance(f, (LessThan, LessThanOrEqual)):
                hi = int(f.value) + (1 if isinstance(f, LessThanOrEqual) else 0)
                self.hi = hi if self.hi is None else min(self.hi, hi)
            yield f              # bounds prune blocks only; Spark re-checks rows

    def _files(self) -> list[tuple[str, int]]:
        """Path and size of every file to read, by path."""
        from covtab.paths import absolute, is_uri
        from covtab.sources.listing import _entries, is_bigwig_name

        p = absolute(self.path)
        if is_uri(p):
            from pyarrow import fs as pafs
            filesystem, inner = pafs.FileSystem.from_uri(p)
            info = filesystem.get_file_info(inner)
            if info.type == pafs.FileType.File:
                return [(p, info.size)]
        elif os.path.isfile(p):
            return [(p, os.path.getsize(p))]
        out, todo = [], [p]
        while todo:
            for name, path, is_dir, size, _ in _entries(todo.pop()):
                if is_dir and self.recursive:
                    todo.append(path)
                elif not is_dir and is_bigwig_name(name):
                    out.append((path, size))
        return sorted(out)

    def partitions(self):
        step = max(1, self.chunk_bytes)
        parts = [_FileRange(path, lo, lo + step) for path, size in self._files()
                 for lo in range(0, max(1, size), step)]
        return parts or [_FileRange(None)]

    def read(self, partition: _FileRange):
        from covtab.sources.bigwig import _const, decode_range, index_file, open_file

        path = partition.path
        if path is None:
            return
        bounds = None if self.lo is None and self.hi is None else (self.lo, self.hi)
        chunks = index_file(path, self.chroms, bounds, self.chunk_bytes, normalize=False,
                            within=(partition.lo, partition.hi))
        with open_file(path) as f:
            for (_k, comp, lo, hi, nb, ids, names, _s) in chunks:
                name_arr = pa.array(names, pa.string())
                for pos, s, e, v in decode_range(f, comp, lo, hi, nb, ids):
                    chrom = pa.DictionaryArray.from_arrays(pa.array(pos), name_arr)
                    yield pa.RecordBatch.from_arrays(
                        [_const(path, len(s)), chrom.cast(pa.string()), pa.array(s),
                         pa.array(e), pa.array(v)],
                        names=["file_path", "chrom", "start0", "end0", "score"])


class BigWigDataSource(DataSource):
    @classmethod
    def name(cls):
        return "bigwig"

    def schema(self):
        return SOURCE_SCHEMA

    def reader(self, schema):
        return BigWigReader(self.options)


def register_bigwig_source(spark) -> None:
    """Register the source and enable filter pushdown for Python sources."""
    from covtab.session import ship_package

    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BigWigDataSource)
