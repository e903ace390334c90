"""Input discovery as Spark jobs.

Directory trees are listed by executors: each level is a DataFrame of
directories, repartitioned and expanded with ``mapInPandas``, so a root with
many studies, groups or files is listed in parallel. Local paths (on a file
system every executor sees) and URIs that ``pyarrow.fs`` understands are told
apart row by row. A directory that cannot be listed fails the job: a listing
is never silently short.
"""

from __future__ import annotations

import os
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covtab import paths
from covtab.functions.intervals import group_from_bigwig_dir, study_from_bigwig_dir
from covtab.schema import BIGWIG_SUFFIXES, MANIFEST_COLUMNS
from covtab.session import checkpoint_dir

BIGWIG_DIR_NAME = "bigwig"
SAMPLE_LISTED = 20  # entries an error message shows of a longer list

DIRS_SCHEMA = "study_name string, qtl_group string, bigwig_dir string"
FILES_SCHEMA = ("study_name string, qtl_group string, bigwig_dir string, "
                "file_path string, size long, modified long")


class DiscoveryError(RuntimeError):
    pass


def _entries(path: str) -> list[tuple[str, str, bool, int, int]]:
    """``(name, path, is_directory, size, modified in ns)`` of a directory."""
    if paths.is_uri(path):
        from pyarrow import fs as pafs
        filesystem, inner = pafs.FileSystem.from_uri(path)
        out = []
        for i in filesystem.get_file_info(pafs.FileSelector(inner)):
            out.append((i.base_name, f"{path.rstrip('/')}/{i.base_name}",
                        i.type == pafs.FileType.Directory, i.size or 0, i.mtime_ns or 0))
        return out
    out = []
    with os.scandir(paths.plain(path)) as it:
        for e in it:
            if e.is_dir():
                out.append((e.name, e.path, True, 0, 0))
            elif e.is_file():
                st = e.stat()
                out.append((e.name, e.path, False, st.st_size, st.st_mtime_ns))
    return out


def _study_dirs(it):
    for pdf in it:
        out = []
        for root in pdf["root"]:
            out.extend((name, path) for name, path, is_dir, _, _ in _entries(root) if is_dir)
        yield pd.DataFrame(out, columns=["study_name", "study_dir"])


def _group_dirs(it):
    for pdf in it:
        out = []
        for study, sdir in zip(pdf["study_name"], pdf["study_dir"]):
            for group, path, is_dir, _, _ in _entries(sdir):
                if is_dir:
                    # exact name, a directory
                    out.extend((study, group, p) for name, p, d, _, _ in _entries(path)
                               if d and name == BIGWIG_DIR_NAME)
        yield pd.DataFrame(out, columns=MANIFEST_COLUMNS)


def _partitions(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def discover_bigwig_dirs(spark: SparkSession, root: str, study: str | None = None) -> DataFrame:
    """S1 (and S2 with ``study``): every ``<root>/<study>/<group>/bigwig``
    directory, exactly three levels deep, sorted by (study, group) name.
    Columns: study_name, qtl_group, bigwig_dir."""
    root = paths.absolute(root)
    if not paths.is_directory(spark, root):
        raise DiscoveryError(f"no such directory to search: {root}")
    seed = spark.createDataFrame([(root,)], "root string")
    if study is None:
        studies = seed.mapInPandas(_study_dirs, "study_name string, study_dir string")
    else:
        study_dir = f"{root.rstrip('/')}/{study}"
        if not paths.is_directory(spark, study_dir):
            return spark.createDataFrame([], DIRS_SCHEMA)
        studies = seed.select(F.lit(study).alias("study_name"), F.lit(study_dir).alias("study_dir"))
    dirs = (studies.repartition(_partitions(spark))
                   .mapInPandas(_group_dirs, DIRS_SCHEMA))
    return dirs.orderBy("study_name", "qtl_group")


def bigwig_dirs_from_paths(listed: DataFrame, root: str, path_col: str = "path") -> DataFrame:
    """S1 on an already-listed set of directory paths: keep exactly
    '<root>/<study>/<group>/bigwig' and split out study and group (P9)."""
    root = root.rstrip("/") + "/"
    p = F.col(path_col)
    below = F.split(F.substr(p, F.lit(len(root) + 1)), "/")
    exact = (p.startswith(root) & (F.size(below) == 3) & (below[2] == BIGWIG_DIR_NAME)
             & (below[0] != "") & (below[1] != ""))
    return (listed.filter(exact)
                  .select(study_from_bigwig_dir(p).alias("study_name"),
                          group_from_bigwig_dir(p).alias("qtl_group"),
                          p.alias("bigwig_dir"))
                  .orderBy("study_name", "qtl_group"))


def is_bigwig_name(name: str) -> bool:
    """S4 name rule: '*.bw' or '*.bigwig', case-sensitive; dot-files skipped."""
    return name.endswith(BIGWIG_SUFFIXES) and not name.startswith(".")


_LEVEL_SCHEMA = f"{FILES_SCHEMA}, is_dir boolean"


LISTED_AT_ONCE = 8192  # entries of a directory that a task holds as rows


def _list_level(it):
    """Coverage files and subdirectories of each directory row. A manifest's
    directory that does not exist has no files, which ``require_files`` reports;
    a subdirectory that vanishes while it is walked is an error."""
    names = ["study_name", "qtl_group", "bigwig_dir", "file_path", "size", "modified", "is_dir"]
    for pdf in it:
        out = []
        for s, g, top, d in zip(pdf["study_name"], pdf["qtl_group"], pdf["bigwig_dir"],
                                pdf["dir"]):
            try:
                entries = _entries(d)
            except (FileNotFoundError, NotADirectoryError):
                if d != top:
                    raise
                continue
            for name, p, is_dir, size, modified in entries:
                if is_dir or is_bigwig_name(name):
                    out.append((s, g, top, p, size, modified, is_dir))
                if len(out) == LISTED_AT_ONCE:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        yield pd.DataFrame(out, columns=names)


def list_bigwig_files(dirs: DataFrame, recursive: bool = False) -> DataFrame:
    """S4/S5 + S13: coverage files of every directory row, with their size and
    time of change. ``dirs`` needs bigwig_dir; study_name/qtl_group are carried
    if present. Recursive listing goes level by level, every level spread over
    the executors."""
    spark = dirs.sparkSession
    level = dirs.select(
        *[F.col(c) if c in dirs.columns else F.lit(None).cast("string").alias(c)
          for c in ("study_name", "qtl_group")],
        "bigwig_dir", F.col("bigwig_dir").alias("dir"))

    def listed(level: DataFrame) -> DataFrame:
        return level.repartition(_partitions(spark)).mapInPandas(_list_level, _LEVEL_SCHEMA)
    if not recursive:
        return listed(level).filter(~F.col("is_dir")).drop("is_dir")
    checkpoint_dir(spark)
    found = None
    while True:
        here = listed(level).checkpoint(eager=True)
        files = here.filter(~F.col("is_dir")).drop("is_dir")
        found = files if found is None else found.unionByName(files)
        level = here.filter("is_dir").select("study_name", "qtl_group", "bigwig_dir",
                                             F.col("file_path").alias("dir"))
        if level.isEmpty():
            return found


def list_bigwig_paths(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """S5 for one directory (or one file): files sorted by path."""
    path = paths.absolute(path)
    if not paths.exists(spark, path):
        raise DiscoveryError(f"neither a file nor a directory: {path}")
    if not paths.is_directory(spark, path):
        found = list_bigwig_files(spark.createDataFrame([(paths.parent(path),)],
                                                        "bigwig_dir string"))
        return found.filter(F.col("file_path") == path)
    seed = spark.createDataFrame([(None, None, path)], DIRS_SCHEMA)
    # path order component by component ('a/b/x' before 'a/b-c/x')
    return list_bigwig_files(seed, recursive).orderBy(F.split("file_path", "/"))


def require_files(dirs: DataFrame, files: DataFrame) -> None:
    """Every directory must hold at least one coverage file. The error
    has the exact number of those that do not and a sample of them."""
    empty = dirs.select("bigwig_dir").join(files.select("bigwig_dir").distinct(),
                                           "bigwig_dir", "left_anti").distinct()
    n = empty.count()
    if n:
        shown = [r["bigwig_dir"] for r in empty.orderBy("bigwig_dir").limit(SAMPLE_LISTED).collect()]
        raise DiscoveryError(f"{n} input directories hold no coverage file; the first "
                             f"{len(shown)}: " + ", ".join(shown))


def discover_bigwig_files(spark: SparkSession, root: str, study: str | None = None) -> DataFrame:
    """S1 + S4 in one step for a root given as an object-store / HDFS URI
    (no directory listing API there): Spark lists every '*.bw'/'*.bigwig'
    below the root, and a file is kept when it sits directly in an exact
    '<root>/<study>/<group>/bigwig' directory. Spark's listing hides names
    starting with '_' or '.'. For POSIX roots prefer
    ``discover_bigwig_dirs`` + ``list_bigwig_files`` (they also report
    directories without files)."""
    def strip_scheme(p: str) -> str:
        return re.sub(r"^file:(//)?", "", p)

    base = root.rstrip("/")
    listed = (spark.read.format("binaryFile")
              .option("pathGlobFilter", "*.{bw,bigwig}")
              .option("recursiveFileLookup", "true")
              .load(base if study is None else f"{base}/{study}")
              .select(F.col("path").alias("file_path"), F.col("length").cast("long").alias("size"),
                      (F.unix_micros("modificationTime") * 1000).alias("modified")))
    norm_base = strip_scheme(base)
    norm_path = F.regexp_replace("file_path", "^file:(//)?", "")
    rel = F.split(F.substring(norm_path, len(norm_base) + 2, 1 << 20), "/")
    return (listed.withColumn("_rel", rel)
            .filter((F.size("_rel") == 4) & (F.element_at("_rel", 3) == BIGWIG_DIR_NAME))
            .select(F.element_at("_rel", 1).alias("study_name"),
                    F.element_at("_rel", 2).alias("qtl_group"),
                    F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1).alias("bigwig_dir"),
                    "file_path", "size", "modified"))
