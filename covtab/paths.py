"""Paths that are either local (shared POSIX) or URIs of another file system."""

from __future__ import annotations

import os
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def is_uri(path: str) -> bool:
    """Whether ``path`` names a file system other than the local one."""
    return "://" in path and not path.startswith("file:")


def plain(path: str) -> str:
    """A ``file:`` URI as a local path; anything else as it is."""
    if path.startswith("file:"):
        return unquote(urlparse(path).path)
    return path


def from_listing(path: str) -> Column:
    """A path as Spark's file listing names it, as this module takes them:
    listings show names as they are, while URIs have theirs percent-encoded."""
    bare = F.regexp_replace(path, "^file:(//)?(?=/)", "")
    return F.when(bare.contains("://"), F.replace(bare, F.lit("%"), F.lit("%25"))).otherwise(bare)


def absolute(path: str) -> str:
    """A local path made absolute; URIs of other file systems as they are."""
    return path if is_uri(path) else os.path.abspath(os.path.expanduser(plain(path)))


def parent(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[0]


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return bool(fs.exists(jpath))


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return bool(fs.exists(jpath)) and bool(fs.getFileStatus(jpath).isDirectory())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory; none if it is missing."""
    fs, jpath = _hadoop(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or tree this library wrote; a missing one is no error."""
    fs, jpath = _hadoop(spark, path)
    fs.delete(jpath, True)


def make_directory(spark: SparkSession, path: str) -> None:
    fs, jpath = _hadoop(spark, path)
    if not fs.mkdirs(jpath):
        raise OSError(f"cannot make the directory {path}")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, its directories included."""
    fs, jpath = _hadoop(spark, path)
    fs.create(jpath, True).close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a file or tree within one file system to a path that is free."""
    fs, jpath = _hadoop(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    if fs.exists(target):
        raise FileExistsError(f"{to} is taken")
    if not fs.mkdirs(target.getParent()) or not fs.rename(jpath, target):
        raise OSError(f"cannot move {path} to {to}")


def copy(spark: SparkSession, path: str, to: str) -> None:
    fs, jpath = _hadoop(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    if not spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
            fs, jpath, fs, target, False, spark._jsc.hadoopConfiguration()):
        raise OSError(f"cannot copy {path} to {to}")


def glob_safe(path: str) -> str:
    """``path`` with the characters escaped that a glob pattern gives a meaning."""
    return "".join(f"\\{c}" if c in "*?[]{}\\," else c for c in path)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted."""
    fs, jpath = _hadoop(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(jpath) or [])
