"""Prompt configurations, one JSON object per file: `folder/<dataset>/<config>.json`."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptloom.constants import CONFIG_KEYS, CONFIGS_FOLDER


def read_configs(spark: SparkSession, folder: str = CONFIGS_FOLDER) -> DataFrame:
    """Every configuration of the folder as a table with a fixed schema.

    `name` in the file becomes `dataset_config`; the folders above the file give
    `dataset_name`. A file that is not a JSON object, or has no name, raises ValueError.
    """
    entries = _config_entries(spark, folder)
    decoded = F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    inside = F.element_at(F.split(decoded, _tail_of(folder)), -1)
    return entries.select(
        F.regexp_extract(inside, "^(.*)/[^/]*$", 1).alias("dataset_name"),
        F.col("entries")["name"].alias("dataset_config"),
        *[F.col("entries")[key].alias(key) for key in CONFIG_KEYS],
    )


def read_config(
    spark: SparkSession, dataset_name: str, name: str | None, folder: str = CONFIGS_FOLDER
) -> dict[str, str] | None:
    """One configuration with all its keys; None without a name."""
    if not name:
        return None
    file = f"{folder}/{dataset_name}/{name}"
    path = file if file.endswith(".json") else f"{file}.json"
    config = dict(_config_entries(spark, path).select("entries").first()["entries"])
    if config:
        config["dataset_config"] = config.pop("name")
    return config


def _config_entries(spark: SparkSession, path: str) -> DataFrame:
    """Files as maps from key to text. There are few and they are small, so all are checked here."""
    try:
        files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"There is no file at {path}") from error
        raise
    entries = files.select("_metadata", F.from_json("value", "map<string, string>").alias("entries"))
    _raise_for(entries, F.col("entries").isNull(), "is not a JSON object")
    unnamed = (F.size("entries") > 0) & F.col("entries")["name"].isNull()
    _raise_for(entries, unnamed, "has no 'name' key")
    return entries


def _raise_for(entries: DataFrame, broken: Column, problem: str) -> None:
    first = entries.filter(broken).select("_metadata.file_path").first()
    if first:
        raise ValueError(f"Configuration {first[0]} {problem}")


def _tail_of(folder: str) -> str:
    r"""Pattern for the folder inside a file's URI."""
    return r"\Q" + "/" + folder.rstrip("/").split("/")[-1] + "/" + r"\E"
