"""From raw documents to packed training sequences: five stages, each over all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import near_texts, packing, quality, secret_scan, suffixes
from contrail.session import stored_result


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the calibrated ones of their language."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near_texts.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id holds; a text that lost all of itself goes."""
    return suffixes.without_repeats(docs, length="n_chars")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets replaced by a mark."""
    return secret_scan.redact(docs, length="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("secret_scans", secret_scans),
    ("packing", pack),
]

# Fingerprints, suffixes and token ids are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again; what a stage stores on its way goes once its result is stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored_result(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
