"""Profiles, lineage and parameter records."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from promptloom.constants import DATASETS_FOLDER, PARAM_LENGTH_LIMIT
from promptloom.functions.values import commit_hash, printed, sanitized_name


def profile(df: DataFrame, *by: str) -> DataFrame:
    """The number of rows, of the whole dataset or of each of its parts."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("num_rows"))


def sample_row(df: DataFrame) -> dict | None:
    """The first row."""
    row = df.first()
    return row.asDict(recursive=True) if row else None


def observed(df: DataFrame, name: str = "profile") -> tuple[DataFrame, Observation]:
    """The rows, and an observation that holds `num_rows` once they have been written.

    Counting while the job's own write runs saves a second pass over the data.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("num_rows")), observation


def lineage_record(
    spark: SparkSession,
    dataset_name: str,
    num_rows: int,
    schema: str,
    split: str | None = None,
    checksum_urls: Sequence[str] = (),
    folder: str = DATASETS_FOLDER,
) -> DataFrame:
    """One lineage row. A dataset with a revision in its checksums comes from a hub, else from storage."""
    first_url = next(iter(checksum_urls), None)
    row = spark.createDataFrame(
        [(dataset_name, split, first_url, num_rows, schema)],
        "dataset_name string, split string, url string, num_rows bigint, schema string",
    )
    stored = F.concat(F.lit(f"{folder}/"), F.col("dataset_name"))
    revision = commit_hash(F.col("url"))
    return row.select(
        sanitized_name(F.col("dataset_name")).alias("name"),
        "split",
        F.when(revision.isNotNull(), "hub").otherwise("storage").alias("source_type"),
        F.when(revision.isNotNull(), F.col("dataset_name")).otherwise(stored).alias("source"),
        revision.alias("commit_hash"),
        "num_rows",
        "schema",
    )


def dataset_records(
    df: DataFrame,
    dataset_name: str,
    split: str | None,
    params: Mapping[str, object] | None = None,
    checksum_urls: Sequence[str] = (),
    folder: str = DATASETS_FOLDER,
    num_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """What a job records of the dataset it loads: its lineage, and its profile and parameters, routed.

    Rows are counted unless their number is known; for Parquet that reads no data. The schema and
    the first row, as JSON, are parameters like the job's own.
    """
    first = sample_row(df)
    profiled = {"schema": df.schema.simpleString(), "first_row": json.dumps(first, default=str, ensure_ascii=False)}
    count = df.count() if num_rows is None else num_rows
    lineage = lineage_record(df.sparkSession, dataset_name, count, profiled["schema"], split, checksum_urls, folder)
    return lineage, route_params(param_rows(df.sparkSession, profiled | {"num_rows": count} | dict(params or {})))


def param_rows(spark: SparkSession, params: Mapping[str, object] | None) -> DataFrame:
    """A run's parameters as key and value; none where there are none."""
    rows = [(key, str(value)) for key, value in (params or {}).items()]
    return spark.createDataFrame(rows, "key string, value string")


def route_params(df: DataFrame, value: str | Column = "value") -> DataFrame:
    """Rows with a `route`: values below the length limit are parameters, longer ones text files."""
    text = printed(F.col(value) if isinstance(value, str) else value)
    return df.withColumn("route", F.when(F.length(text) < PARAM_LENGTH_LIMIT, "param").otherwise("text"))
