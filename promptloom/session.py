"""Session set-up that a job may need."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives executors this package, for sessions not started with it in `--py-files`."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="promptloom-"), "promptloom"),
        "zip",
        os.path.dirname(package),
        os.path.basename(package),
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read from there, so they are not computed again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a local one only where it names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="promptloom-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder
