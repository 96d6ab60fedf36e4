"""A corpus pipeline over `documents`: language ID, exact dedup, near dedup, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from pagewright.llm import exact_dedup, language_id, mixing, packing, simhash
from pagewright.llm.scratch import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the known languages go."""
    return language_id.keep_known(docs)


def stage_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest doc_id stays."""
    return exact_dedup.drop_exact(docs)


def stage_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with linked fingerprints, the one with the smallest doc_id stays."""
    return simhash.drop_near(docs)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out to the targets of their sources."""
    return mixing.mix_documents(docs)


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the mix: a row per piece of a document."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", stage_language),
    ("exact_dedup", stage_exact),
    ("simhash", stage_near),
    ("mixing", stage_mix),
    ("packing", stage_pack),
]

#: Fingerprints and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that the one before it kept, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = store(docs, f"stage_{name}")
    return docs
