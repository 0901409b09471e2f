"""The queries of this subpackage, with the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from promptloom.llm import (
    bpe,
    licences,
    minhash,
    mixing,
    ordinal,
    pieces,
    repair,
    repetition,
    spotsigs,
    suffixes,
    token_files,
    toxicity,
    whitening,
)
from promptloom.llm.sql import BASE_SQL, LICENCE_SQL, MIXING_SQL, NEAR_DUPLICATE_SQL, REPAIR_SQL, REPEATED_SPAN_SQL
from promptloom.session import shared_folder, ship_package

END_ID = 2


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/{uuid.uuid4()}"
    token_files.write_token_files(_documents(spark, sf_dir), folder, corpus_pipeline.tokenizer_path(), END_ID)
    return token_files.read_token_digests(spark, folder)


def op2_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op3_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_report(_documents(spark, sf_dir))


def op4_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_report(_documents(spark, sf_dir))


def op5_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_report(_documents(spark, sf_dir))


def op6_bpe_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_documents(_documents(spark, sf_dir), corpus_pipeline.tokenizer_path())


def op7_bwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_report(_documents(spark, sf_dir))


def op8_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir).select("doc_id", "text", "source")
    return mixing.with_copies(documents).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
    )


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    # 0: bad, 1: good but toxic, 2: good.
    grade = F.col("quality") * (2 - F.col("toxic"))
    model = ordinal.quality_model(documents, labels, grade)
    return ordinal.graded_documents(documents, model)


def op10_toxic_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_documents(documents, toxicity.toxicity_model(documents, labels))


def op11_divide_and_conquer_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return whitening.whitened_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_documents(_documents(spark, sf_dir), corpus_pipeline.tokenizer_path("piece_bpe_32k.model"))


def op13_suffix_automaton_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return repair.repair_report(repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repair_token_files": op1_repair_token_files,
    "op2_bbit_minhash": op2_bbit_minhash,
    "op3_licence_sentences": op3_licence_sentences,
    "op4_spot_signatures": op4_spot_signatures,
    "op5_repetition_coverage": op5_repetition_coverage,
    "op6_bpe_merge_rounds": op6_bpe_merge_rounds,
    "op7_bwt_repeats": op7_bwt_repeats,
    "op8_mix_to_weights": op8_mix_to_weights,
    "op9_ordinal_quality": op9_ordinal_quality,
    "op10_toxic_sentences": op10_toxic_sentences,
    "op11_divide_and_conquer_whitening": op11_divide_and_conquer_whitening,
    "op12_piece_agenda": op12_piece_agenda,
    "op13_suffix_automaton_repair": op13_suffix_automaton_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op2_bbit_minhash": NEAR_DUPLICATE_SQL,
    "op3_licence_sentences": LICENCE_SQL,
    "op5_repetition_coverage": BASE_SQL,
    "op7_bwt_repeats": REPEATED_SPAN_SQL,
    "op8_mix_to_weights": MIXING_SQL,
    "op13_suffix_automaton_repair": REPAIR_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
