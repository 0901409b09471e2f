"""Questions to the file system that Spark would answer by listing whole folders."""

from __future__ import annotations

from pyspark.sql import SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks for the one path in the file system it belongs to; nothing is listed."""
    system, place = _placed(spark, path)
    return bool(system.exists(place))


def is_folder(spark: SparkSession, path: str) -> bool:
    system, place = _placed(spark, path)
    return bool(system.exists(place) and system.getFileStatus(place).isDirectory())


def _placed(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place
