"""Completions written as JSON."""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptloom.constants import COMPLETIONS_FOLDER
from promptloom.sources.files import path_exists

logger = logging.getLogger(__name__)


def save_completions(df: DataFrame, name: str | None = None, folder: str = COMPLETIONS_FOLDER) -> str:
    """The whole table as JSON records, null fields included; returns the path written.

    The path is a directory of JSON Lines files, `completions_<time>.json` unless named.
    """
    name = name or f"completions_{datetime.now():%Y%m%d-%H%M%S}"
    path = f"{folder}/{name}" if name.endswith(".json") else f"{folder}/{name}.json"
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def finished(tasks: DataFrame) -> DataFrame:
    """`task_id, completions` of the tasks that are done."""
    return tasks.filter(F.col("status") == "done").select("task_id", "completions")


def save_task_completions(tasks: DataFrame, folder: str = COMPLETIONS_FOLDER) -> bool:
    """One directory per finished task with its completions; nothing if the folder is absent.

    Only the directories of these tasks are replaced, so a batch that runs again leaves one
    copy. Rows of a task are brought together first, for one file in each directory. Directories
    grow with the tasks: `task_table` holds very many of them in few files.
    """
    if not path_exists(tasks.sparkSession, folder):
        logger.warning("Folder %s not found: completions are not saved", folder)
        return False
    (
        finished(tasks).repartition("task_id")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False)
        .partitionBy("task_id").json(folder)
    )
    return True
