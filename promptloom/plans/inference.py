"""From a named dataset to its completions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from promptloom.constants import (
    COMPLETIONS_FOLDER,
    CONFIGS_FOLDER,
    DATASETS_FOLDER,
    INFERENCE,
    INFERENCE_SPLIT,
    INPUT,
)
from promptloom.operators.configs import merge_config
from promptloom.operators.generation import Engine, batch_sampling, completion
from promptloom.operators.inference import PROMPT, format_prompts, input_prompts, with_completions
from promptloom.operators.records import dataset_records, observed
from promptloom.sinks.completions import save_completions
from promptloom.sinks.records import append_records
from promptloom.sources.configs import read_config
from promptloom.sources.datasets import read_dataset

# The dataset may have a column `prompt` of its own.
_PROMPT = "_prompt"
# The directories of a job's batches.
_BATCH = "completion_batch"


def complete_dataset(
    df: DataFrame,
    engine: Engine,
    config: Mapping[str, str | None] | None = None,
    sampling: Mapping[str, object] | None = None,
    model_template: str | None = None,
    input_column: str = INPUT,
    output_column: str = INFERENCE,
    keep_prompt: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """The rows with a completion of their input.

    Rows stay where they are, unless `partitions` asks to spread them: worth a shuffle when a
    few large files would leave most workers without rows.
    """
    if partitions:
        df = df.repartition(partitions)
    prompts = input_prompts(df, input_column, _PROMPT)
    formatted = format_prompts(prompts, config, model_template, prompt_column=_PROMPT)
    made = completion(F.col(_PROMPT), engine, batch_sampling(**(sampling or {})))
    completed = with_completions(formatted, made, output_column)
    return completed.withColumnRenamed(_PROMPT, PROMPT) if keep_prompt else completed.drop(_PROMPT)


@dataclass(frozen=True)
class InferenceRun:
    path: str
    num_rows: int


def run_inference(
    spark: SparkSession,
    engine: Engine,
    dataset_name: str,
    split: str | None = None,
    dataset_config: str | None = None,
    sampling: Mapping[str, object] | None = None,
    model_template: str | None = None,
    input_column: str = INPUT,
    output_column: str = INFERENCE,
    output_name: str | None = None,
    partitions: int | None = None,
    datasets_folder: str = DATASETS_FOLDER,
    configs_folder: str = CONFIGS_FOLDER,
    completions_folder: str = COMPLETIONS_FOLDER,
    records_folder: str | None = None,
    schema: StructType | str | None = None,
    checksum_urls: Sequence[str] = (),
) -> InferenceRun:
    """Completes a named dataset and writes it, with lineage and parameters if a folder is given.

    Rows are counted while they are written, so the data is read once after schema inference; a
    `schema` spares that too. `checksum_urls` are those that a hub gave for the dataset's files.
    """
    split = split or INFERENCE_SPLIT
    df = read_dataset(spark, dataset_name, split, datasets_folder, schema)
    config = merge_config(read_config(spark, dataset_name, dataset_config, configs_folder))
    completed, counts = observed(
        complete_dataset(
            df, engine, config, sampling, model_template, input_column, output_column, partitions=partitions
        )
    )
    path = save_completions(completed, output_name, completions_folder)
    num_rows = counts.get["num_rows"]
    if records_folder:
        params = config | batch_sampling(**(sampling or {}))
        records = dataset_records(df, dataset_name, split, params, checksum_urls, datasets_folder, num_rows)
        append_records(records, records_folder)
    return InferenceRun(path, num_rows)


def complete_in_batches(
    files: DataFrame,
    engine: Engine,
    folder: str,
    config: Mapping[str, str | None] | None = None,
    sampling: Mapping[str, object] | None = None,
    model_template: str | None = None,
    input_column: str = INPUT,
    output_column: str = INFERENCE,
    partitions: int | None = None,
) -> DataFrame:
    """Completes a dataset some files at a time into `folder`, so that a job that ends midway goes on.

    `files` is a stream of the dataset's files; its `maxFilesPerTrigger` or `maxBytesPerTrigger` bounds
    a batch. A batch owns one directory, which it replaces if it runs again. A job started again with
    the same folder completes what is left: at most the one batch that was not finished runs twice.
    Files that arrive later are completed by the next start. Returns the completions so far.
    """

    def complete_batch(batch: DataFrame, batch_id: int) -> None:
        done = complete_dataset(
            batch, engine, config, sampling, model_template, input_column, output_column, partitions=partitions
        )
        done.write.mode("overwrite").parquet(f"{folder}/completions/{_BATCH}={batch_id}")

    query = (
        files.writeStream.foreachBatch(complete_batch).option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return files.sparkSession.read.parquet(f"{folder}/completions").drop(_BATCH)
