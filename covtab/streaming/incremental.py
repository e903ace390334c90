"""Incremental runs (J9): convert only what changed.

Two ways to re-use finished work:

* ``pending_groups`` — batch: a (study, group) needs converting when the
  results table has no row for it with the same output, region suffix and
  input fingerprint, or when its published table is gone. The fingerprint is
  the file count with an xor and a sum over hashes of (path, size, time of
  change) — order-independent and computed by a plain aggregate, so no file
  list is ever gathered into one task.
* ``start_manifest_stream`` — streaming: a Structured Streaming query over a
  directory of manifest files. The rows of newly arrived manifests are
  converted micro-batch by micro-batch (``foreachBatch``), each manifest by the
  names in its own header, and only as far as they are pending: the results
  table makes a batch that runs again after a crash, or a manifest that names
  groups converted before, cost a look-up. Groups that cannot be converted as
  the manifests stand are reported and left out, so the stream goes on.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covtab import paths
from covtab.plans.jobs import ConversionResult, convert_files
from covtab.region import RegionSpec, table_path_col
from covtab.session import checkpoint_dir
from covtab.sources.listing import list_bigwig_files, require_files
from covtab.sources.manifest import check_manifest, read_manifest

DONE_SCHEMA = ("output string, study_name string, qtl_group string, suffix string, n_files long, "
               "fp_xor long, fp_sum decimal(38,0), rows_written long, finished_at timestamp")

KEYS = ["study_name", "qtl_group"]
FINGERPRINT = ["n_files", "fp_xor", "fp_sum"]
MANIFESTS_PER_BATCH = 64  # manifest files of one micro-batch


def input_fingerprints(files: DataFrame) -> DataFrame:
    """Per (study, group): number of files and order-independent hashes of
    their (path, size, time of change)."""
    h = F.xxhash64("file_path", "size", "modified")
    return files.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_files"), F.bit_xor(h).alias("fp_xor"),
        F.sum(h.cast("decimal(38,0)")).alias("fp_sum"))


def _current(manifest: DataFrame, files: DataFrame, output: str, region: RegionSpec) -> DataFrame:
    return (manifest.select(*KEYS, "bigwig_dir")
            .join(input_fingerprints(files), KEYS, "left")
            .withColumn("n_files", F.coalesce("n_files", F.lit(0).cast("long")))
            .withColumn("output", F.lit(output)).withColumn("suffix", F.lit(region.suffix)))


def pending_groups(manifest: DataFrame, files: DataFrame, done: DataFrame, output: str,
                   region: RegionSpec | None = None) -> DataFrame:
    """Manifest rows whose inputs changed or that were never converted to this
    output with this region."""
    region = region or RegionSpec()
    current = _current(manifest, files, paths.absolute(output), region)
    same = ["output", *KEYS, "suffix", *FINGERPRINT]
    match = [current[c].eqNullSafe(done[c]) for c in same]
    return current.join(done, match, "left_anti")


def _existing(it):
    from covtab.sources.listing import _entries
    for pdf in it:
        found = []
        for table in pdf["table"]:
            try:
                found.append(any(name.startswith("chrom_rank=") for name, *_ in _entries(table)))
            except (FileNotFoundError, NotADirectoryError):
                found.append(False)
        yield pdf[KEYS].assign(published=pd.array(found, bool))


def published_groups(manifest: DataFrame, output: str, region: RegionSpec | None = None
                     ) -> DataFrame:
    """The (study, group) rows of a manifest whose table exists, looked up by
    the executors."""
    table = table_path_col(paths.absolute(output), F.col("study_name"), F.col("qtl_group"),
                           region or RegionSpec())
    return (manifest.select(*KEYS, table.alias("table"))
            .mapInPandas(_existing, "study_name string, qtl_group string, published boolean")
            .filter("published").drop("published"))


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """The results table; empty when it does not exist yet."""
    if not paths.exists(spark, path):
        return spark.createDataFrame([], DONE_SCHEMA)
    return spark.read.schema(DONE_SCHEMA).parquet(path)


def record_done(path: str, files: DataFrame, region: RegionSpec, result: ConversionResult
                ) -> None:
    """Append one results row per converted (study, group)."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    (input_fingerprints(files).join(result.groups, KEYS)
     .select(F.lit(result.output).alias("output"), *KEYS, F.lit(region.suffix).alias("suffix"),
             *FINGERPRINT, "rows_written", F.lit(now).cast("timestamp").alias("finished_at"))
     .write.mode("append").parquet(path))


def convert_pending(spark: SparkSession, manifest: DataFrame, output: str, done_path: str,
                    region: RegionSpec | None = None, **kw) -> ConversionResult | None:
    """J9 batch: convert only pending groups, then record them as done.
    Returns the ConversionResult, or None when nothing was pending."""
    region = region or RegionSpec()
    checkpoint_dir(spark)
    manifest = manifest.checkpoint(eager=True)
    check_manifest(manifest)
    # one listing, written once: the files converted are exactly the files
    # whose fingerprint is recorded as done
    files = list_bigwig_files(manifest).checkpoint(eager=True)
    require_files(manifest, files)
    pending = pending_groups(manifest, files, read_done(spark, done_path), output, region)
    gone = manifest.join(published_groups(manifest, output, region), KEYS, "left_anti")
    todo = pending.select(*KEYS).unionByName(gone.select(*KEYS)).distinct()
    todo_files = files.join(todo, KEYS, "left_semi").checkpoint(eager=True)
    if todo_files.isEmpty():
        return None
    result = convert_files(spark, todo_files, output, region, **kw)
    record_done(done_path, todo_files, region, result)
    return result


REJECTED_SCHEMA = ("study_name string, qtl_group string, bigwig_dir string, reason string, "
                   "batch_id long")


def _rejected(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest rows that stand in the way of their batch, with the reason:
    groups named with several directories, and directories without files."""
    several = (rows.groupBy(*KEYS).agg(F.count_distinct("bigwig_dir").alias("n")).where("n > 1")
               .select(*KEYS, F.lit("the group has several directories").alias("reason")))
    held = files.select("bigwig_dir").distinct()
    empty = (rows.join(held, "bigwig_dir", "left_anti")
             .withColumn("reason", F.lit("the directory holds no coverage file")))
    many = rows.join(several, KEYS)
    return many.select(*KEYS, "bigwig_dir", "reason").unionByName(
        empty.join(several.select(*KEYS), KEYS, "left_anti")
        .select(*KEYS, "bigwig_dir", "reason")).distinct()


def read_rejected(spark: SparkSession, done_path: str) -> DataFrame:
    """What a stream with this results table left out, batch by batch."""
    path = f"{done_path}.rejected"
    if not paths.exists(spark, path):
        return spark.createDataFrame([], REJECTED_SCHEMA)
    return spark.read.schema(REJECTED_SCHEMA).parquet(path)


def convert_batch(spark: SparkSession, manifests: list[str], output: str, done_path: str,
                  batch_id: int, region: RegionSpec | None = None, **kw) -> None:
    """One micro-batch: convert the pending groups of some manifest files,
    record them, and report what was left out. Running it again is no harm: the
    groups are recorded, and the report of a batch replaces itself."""
    rows = reduce(DataFrame.unionByName, [read_manifest(spark, x) for x in manifests])
    checkpoint_dir(spark)
    rows = rows.distinct().checkpoint(eager=True)
    files = list_bigwig_files(rows).checkpoint(eager=True)
    out = _rejected(rows, files).checkpoint(eager=True)
    if not out.isEmpty():
        out.write.mode("overwrite").parquet(f"{done_path}.rejected/batch_id={batch_id}")
    good = rows.join(out.select(*KEYS).distinct(), KEYS, "left_anti")
    if not good.isEmpty():
        convert_pending(spark, good, output, done_path, region, **kw)


def start_manifest_stream(spark: SparkSession, manifest_dir: str, output: str,
                          checkpoint: str, region: RegionSpec | None = None,
                          available_now: bool = True, done_path: str | None = None, **kw):
    """J9 streaming: convert the pending groups of every manifest file that
    lands in ``manifest_dir``. ``done_path`` is the results table, by default
    beside the output; it may be shared with ``convert_pending``. Returns the
    StreamingQuery; with ``available_now`` it processes what is there and stops
    (call ``awaitTermination()``)."""
    region = region or RegionSpec()
    output = paths.absolute(output)
    done = done_path or f"{output}.done"
    stream = (spark.readStream.format("text").option("maxFilesPerTrigger", MANIFESTS_PER_BATCH)
              .load(manifest_dir).select(F.col("_metadata.file_path").alias("manifest")))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # at most MANIFESTS_PER_BATCH names
        names = sorted(r["manifest"] for r in batch.distinct().collect())
        if names:
            convert_batch(batch.sparkSession, names, output, done, batch_id, region, **kw)

    writer = (stream.writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
