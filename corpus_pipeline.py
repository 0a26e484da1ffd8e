"""A corpus from raw documents to tokens: five stages, each over all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faresettle.llm import decontaminate, pieces, quality, secrets, simhash
from faresettle.llm.catalog import table
from faresettle.llm.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays: that with the smallest id."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item's question and answer go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts."""
    return secrets.redact_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become piece ids."""
    return pieces.encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scans", mask_secrets),
    ("sentencepiece_encoding", encode),
]

# Learned scores, hashes and lattices are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: token ids of the documents that every stage kept.

    Each stage reads all rows of the one before from files. Null and empty texts are empty documents, of which near-dedup keeps one if the classifier keeps them; rows
    without an id are near-copies among themselves or of documents with one, as their texts are; repeated rows are copies; columns of any
    name stay to the last stage but one; an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), name)
    return docs
