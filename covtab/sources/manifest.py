"""Manifest of (study, group, directory) rows: read (S3), write (K5), the
planned outputs (K3, A17) and the guards around them (V4, V5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covtab import paths
from covtab.region import RegionSpec, output_name_col, table_path_col
from covtab.schema import MANIFEST_COLUMNS


SAMPLE_LISTED = 20  # entries an error message shows of a longer list


class ManifestError(ValueError):
    pass


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """S3: tab-separated with a header; the three columns are picked by name
    (extra columns ignored), all strings. LF and CRLF line ends both work."""
    if not path or not paths.exists(spark, paths.absolute(path)):
        raise ManifestError(f"no such manifest: {path}")
    df = (spark.read.option("sep", "\t").option("header", True)
          .option("inferSchema", False).csv(paths.absolute(path)))
    missing = [c for c in MANIFEST_COLUMNS if c not in df.columns]
    if missing:
        raise ManifestError(f"the manifest {path} has no column {', '.join(missing)}")
    return df.select(*[F.regexp_replace(F.col(c).cast("string"), "\r$", "").alias(c)
                       for c in MANIFEST_COLUMNS])


def check_manifest(manifest: DataFrame) -> None:
    """V5 and the duplicate rule: at least one row, and no (study, group)
    twice — two rows would publish into the same table."""
    if manifest.isEmpty():
        raise ManifestError("the manifest has no row")
    dup = (manifest.groupBy("study_name", "qtl_group").count().filter(F.col("count") > 1))
    n = dup.count()
    if n:
        shown = ", ".join(f"{r['study_name']}/{r['qtl_group']}" for r in
                          dup.orderBy("study_name", "qtl_group").limit(SAMPLE_LISTED).collect())
        raise ManifestError(f"{n} (study_name, qtl_group) pairs occur more than once, "
                            f"such as {shown}")


def write_manifest(rows: DataFrame, out: str) -> None:
    """K5: header + rows, tab separated, LF line ends, one part file in
    directory ``out`` (overwritten). Nothing is written for zero rows."""
    if rows.isEmpty():
        raise ManifestError("there is no <study>/<group>/bigwig directory to list")
    (rows.select(*MANIFEST_COLUMNS).orderBy("study_name", "qtl_group").coalesce(1)
         .write.mode("overwrite").option("sep", "\t").option("header", True)
         .option("lineSep", "\n").csv(out))


# Fixed value: how a dry run's line begins.
PLAN_PREFIX = "Will write: "


def planned_outputs(manifest: DataFrame, output_base: str, region: RegionSpec) -> DataFrame:
    """K3 + A17: the table each manifest row publishes, with the
    'Will write: <path>' line of a dry run."""
    table = table_path_col(output_base, F.col("study_name"), F.col("qtl_group"), region)
    return manifest.select(
        "study_name", "qtl_group",
        output_name_col(F.col("qtl_group"), region).alias("output_name"),
        table.alias("output_path"),
        F.concat(F.lit(PLAN_PREFIX), table).alias("plan_line"))
