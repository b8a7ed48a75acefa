"""Corpus pipeline: five stages over ``documents``, each by one operator of ``tabloom.llm``.

Toxic documents go, one document of each near-duplicate group stays, benchmark passages are cut out (a document
goes if most of it is benchmark), personal data is masked, and what is left is packed into batches. Every
stage works on all its predecessor kept and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm import decontaminate, packing, pii_bootstrap, simhash_mih, toxic_segments
from tabloom.llm.shared import stash

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the segment scorer rejects."""
    return toxic_segments.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of four-word shingles, linked at four or fewer differing bits."""
    return simhash_mih.keep_one(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of the benchmark."""
    return decontaminate.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With personal data masked."""
    return pii_bootstrap.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in length buckets and token-budget batches."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", pack),
]

#: classifiers and fingerprints are beyond SQL; tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
