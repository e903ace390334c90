"""Replacing published tables by renames (K2).

A publication is written whole, beside what is published:

    <output>/_publish/<region>/<id>/new/study_name=<s>/qtl_group=<g>/...

Once every table of it is complete, a marker file seals it. Then each table is
moved into its place: the one that stands there goes to ``<id>/old``, the new
one takes its name, and at last the publication's folder is removed. A reader
sees a whole old table or a whole new one; tables that the publication does not
hold are never touched.

A crash before the seal leaves the published tables as they were. A crash after
it leaves some tables old and some new, at worst one moved aside and not yet
replaced; ``finish_publications`` carries on from there, and every publication
to the same output and region begins with that. One job writes to a region of
an output at a time. Moves are one metadata operation each where the file
system has renames (HDFS, POSIX); an object store copies instead.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from covtab import paths
from covtab.region import RegionSpec, region_root

_FOLDER = "_publish"  # readers of the output skip names that begin with "_"
_SEAL = "sealed-"


def _publications(output: str, region: RegionSpec) -> str:
    return f"{output.rstrip('/')}/{_FOLDER}/{region.label}"


def new_publication(output: str, region: RegionSpec) -> str:
    """The folder of a publication yet to be written; its tables go below
    ``tables_of`` it."""
    return f"{_publications(output, region)}/{uuid.uuid4().hex}"


def tables_of(publication: str) -> str:
    return f"{publication}/new"


def table_paths(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Tables below ``root``, relative to it: ``depth`` levels of key=value
    directories down."""
    if depth == 0:
        return [""]
    return [f"{name}/{rest}".rstrip("/") for name in sorted(paths.children(spark, root))
            if "=" in name for rest in table_paths(spark, f"{root}/{name}", depth - 1)]


def publish(spark: SparkSession, publication: str, output: str, region: RegionSpec,
            depth: int) -> None:
    """Seal a publication that is written whole, and put its tables in place."""
    paths.touch(spark, f"{publication}/{_SEAL}{depth}")
    _put_in_place(spark, publication, region_root(output, region), depth)


def finish_publications(spark: SparkSession, output: str, region: RegionSpec) -> None:
    """Carry on with publications whose job ended between seal and removal, and
    remove what was never sealed."""
    folder = _publications(output, region)
    for name in sorted(paths.children(spark, folder)):
        sealed = [x for x in paths.children(spark, f"{folder}/{name}") if x.startswith(_SEAL)]
        if sealed:
            depth = int(sealed[0].removeprefix(_SEAL))
            _put_in_place(spark, f"{folder}/{name}", region_root(output, region), depth)
        else:
            paths.delete(spark, f"{folder}/{name}")


def _put_in_place(spark: SparkSession, publication: str, root: str, depth: int) -> None:
    new = tables_of(publication)
    if paths.exists(spark, new):
        if depth and not paths.exists(spark, root):
            paths.rename(spark, new, root)
        else:
            for table in table_paths(spark, new, depth):
                _swap(spark, f"{new}/{table}".rstrip("/"), f"{root}/{table}".rstrip("/"),
                      f"{publication}/old/{table}".rstrip("/"))
    paths.delete(spark, publication)


def _swap(spark: SparkSession, new: str, place: str, aside: str) -> None:
    if paths.exists(spark, place):
        paths.delete(spark, aside)
        paths.rename(spark, place, aside)
    paths.rename(spark, new, place)
