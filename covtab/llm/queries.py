"""Registered queries of the operators: each applies its operator with
production parameters to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from covtab.llm import ann, audit, langid, licenses, runs, secrets, toxicity
from covtab.llm.chat import rotate
from covtab.llm.histogram import length_histogram, suffix_sums
from covtab.llm.lexicon import build_lexicon, encode_digests
from covtab.llm.neardup import near_duplicates
from covtab.llm.packing import pack_documents
from covtab.llm.quality import verdicts
from covtab.session import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op2_stable_projection_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op3_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op4_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(_table(spark, sf_dir, "conversations"))


def op5_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sums(length_histogram(_table(spark, sf_dir, "documents")))


def op6_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return encode_digests(docs, build_lexicon(docs))


def op7_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


def op8_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs))


def op9_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=2)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(_table(spark, sf_dir, "documents"))


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    index = licenses.build_index(docs)
    return licenses.license_labels(licenses.license_matches(docs, index), index)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return runs.run_digests(runs.periodic_runs(docs, runs.planted_order))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_string_kernel_toxicity": op1_string_kernel_toxicity,
    "op2_stable_projection_search": op2_stable_projection_search,
    "op3_lexical_packing": op3_lexical_packing,
    "op4_perspective_rotation": op4_perspective_rotation,
    "op5_length_histogram": op5_length_histogram,
    "op6_transducer_bpe": op6_transducer_bpe,
    "op7_rank_order_language": op7_rank_order_language,
    "op8_markov_secrets": op8_markov_secrets,
    "op9_superminhash": op9_superminhash,
    "op10_quality_rules": op10_quality_rules,
    "op11_filter_interaction_audit": op11_filter_interaction_audit,
    "op12_license_scan": op12_license_scan,
    "op13_periodic_runs": op13_periodic_runs,
}
