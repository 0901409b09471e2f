"""From a named dataset to a table ready for training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from promptloom.constants import CONFIGS_FOLDER, DATASETS_FOLDER, MAX_SEQ_LENGTH, MESSAGES, TEXT, TRAINING_SPLIT
from promptloom.functions.spans import message_targets, response_spans
from promptloom.operators.configs import merge_config
from promptloom.operators.length import bound_examples, bound_messages
from promptloom.operators.records import dataset_records
from promptloom.operators.training import construct_prompts
from promptloom.sinks.records import append_records
from promptloom.sources.configs import read_config
from promptloom.sources.datasets import read_dataset


def training_table(
    spark: SparkSession,
    dataset_name: str,
    split: str = TRAINING_SPLIT,
    dataset_config: str | None = None,
    dataset_format: str | None = None,
    model_template: str | None = None,
    max_tokens: int = MAX_SEQ_LENGTH,
    datasets_folder: str = DATASETS_FOLDER,
    configs_folder: str = CONFIGS_FOLDER,
    keep: Sequence[str] = (),
    schema: StructType | str | None = None,
    records_folder: str | None = None,
    checksum_urls: Sequence[str] = (),
) -> DataFrame:
    """The dataset of that name as training examples.

    Chat examples are a `messages` column, text examples a `text`, both bounded in length, with
    `was_truncated`. With both markers configured there is also a `targets` column. Only the
    model's own layout decides between chat and text here, never the configured one. With a folder for
    records, the dataset's lineage, its profile and the configuration are written there; a
    `schema` spares a JSON dataset the pass that infers it.
    """
    df = read_dataset(spark, dataset_name, split, datasets_folder, schema)
    config = merge_config(read_config(spark, dataset_name, dataset_config, configs_folder), dataset_format)
    if records_folder:
        append_records(dataset_records(df, dataset_name, split, config, checksum_urls, datasets_folder), records_folder)
    chosen = config.get("dataset_format")
    chat = model_template is not None if chosen not in ("conversational", "text") else chosen == "conversational"
    examples = construct_prompts(df, config.get("instruction"), config.get("text_format"), chat, keep)
    bound = bound_messages if chat else bound_examples
    examples = bound(examples, MESSAGES if chat else TEXT, max_tokens)
    markers = config.get("instruction_part"), config.get("response_part")
    if not all(markers):
        return examples
    targets = message_targets(F.col(MESSAGES)) if chat else response_spans(F.col(TEXT), *markers)
    return examples.withColumn("targets", targets)
