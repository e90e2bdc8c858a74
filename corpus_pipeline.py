"""The pipeline over documents: quality rules, exact dedup, near-dedup, mixing, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearthlake.llm import byte_bpe, exact_dedup, mixing, quality_rules, simhash
from hearthlake.session import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.passing(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each text."""
    return exact_dedup.without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each component of near copies."""
    return simhash.without_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in the order of training."""
    return mixing.curriculum(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to, a row for each taken copy."""
    return byte_bpe.round_trip(docs)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("mix_to_weights", mix),
    ("byte_bpe", encode),
]

#: SQL has no XXH64, so no stage after near-dedup can be expressed; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        folder = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
