"""From raw documents to token ids: rules, duplicates, repeated passages, mixture, encoding."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptloom.llm import bpe, minhash, mixing, repetition, suffixes
from promptloom.session import shared_folder, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    ship_package(spark)
    return repetition.passing_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words to a shingle, similarity 0.8."""
    ship_package(spark)
    return minhash.deduplicated(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of 100 that start earlier elsewhere go; every document stays."""
    ship_package(spark)
    return suffixes.without_repeats(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or left out, so that sources come near their shares."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document of the mixture encoded, and decoded again."""
    ship_package(spark)
    return bpe.encoded_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_copies),
    ("suffix_array_dedup", repeated_passages),
    ("mix_to_weights", mixture),
    ("bpe_encode_decode", token_ids),
]

# SQL has no byte-pair merges; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each is written to the shared folder and read for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/{uuid.uuid4()}"
    for number, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}_{name}")
        docs = spark.read.parquet(f"{folder}/{number}_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
