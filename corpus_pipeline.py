"""The corpus pipeline: ``documents`` to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns what the next one reads;
all but the last return the columns of ``documents``. Texts reach Python in
batches of bounded bytes. Null and empty texts have no language and go at once,
texts with letters stay where no language is labelled;
long texts are worked on as a whole; rows are judged one by one, repeated ones
and those that share or lack a doc_id too; extra columns stay, whatever their
names; an empty table gives an empty result.

1. language: documents whose text lies far from every learned profile go.
2. quality: documents that the threshold table rejects go.
3. near_duplicates: one document of each near-duplicate group stays.
4. secrets: found secrets are masked in the text.
5. packing: the texts become pieces of 1024-token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from covtab.llm import langid, neardup, packing, quality, scratch, secrets
from covtab.session import ship_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents far from every language's rank-order profile."""
    scratch.bound_batches(spark)
    ship_package(spark)
    return langid.keep_known(docs, langid.train(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the threshold table rejects."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group: shingles of five words, linked
    from a similarity of 0.8."""
    ship_package(spark)
    return neardup.keep_one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask the secrets of every text."""
    scratch.bound_batches(spark)
    ship_package(spark)
    return secrets.redact(docs, secrets.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    scratch.bound_batches(spark)
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [("language", language), ("quality", quality_rules),
          ("near_duplicates", near_duplicates), ("secrets", secret_scan), ("packing", pack)]

# Profiles, models, signatures and token ids have no SQL; tests/llm holds every
# stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written as Parquet
    to the shared folder and read back for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch.bound_batches(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
