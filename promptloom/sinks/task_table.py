"""Completions per task as a table sorted by task, of which a lookup opens the file that may hold it."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptloom.sinks.completions import finished, save_task_completions

# Tasks in a file, about; a file has Bloom filters on the id and its range of ids in the table of files.
TASKS_PER_FILE = 200_000
ROW_GROUP_BYTES = 16 << 20

_FILES = "file string, low string, high string, tasks bigint, batch_id bigint"


def write_task_batch(tasks: DataFrame, table: str, batch_id: int, tasks_per_file: int = TASKS_PER_FILE) -> None:
    """Appends the finished tasks of a batch to `table`, sorted by id, with the range of ids of each file.

    The batch owns one directory, which it replaces if it runs again; `tasks` is read twice, so it
    should be a written table. A batch of up to `tasks_per_file` tasks is one file.
    """
    spark = tasks.sparkSession
    done = finished(tasks)
    files = math.ceil(done.count() / tasks_per_file)
    # One file needs no ranges, so nothing is sampled or shuffled by range for it.
    dealt = done.repartitionByRange(files, "task_id") if files > 1 else done.repartition(1)
    path = f"{table}/completions/batch_id={batch_id}"
    (
        dealt.sortWithinPartitions("task_id").write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#task_id", True)
        .option("parquet.bloom.filter.expected.ndv#task_id", tasks_per_file)
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .parquet(path)
    )
    held = spark.read.schema(done.schema).parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min("task_id").alias("low"), F.max("task_id").alias("high"), F.count("*").alias("tasks")
    )
    held.coalesce(1).write.mode("overwrite").parquet(f"{table}/files/batch_id={batch_id}")


def read_task_table(spark: SparkSession, table: str) -> DataFrame:
    """`task_id, completions` of every task, from the last batch that finished it."""
    rows = spark.read.option("basePath", f"{table}/completions").parquet(f"{table}/completions")
    latest = F.max_by("completions", "batch_id").alias("completions")
    return rows.groupBy("task_id").agg(latest)


def task_files(spark: SparkSession, table: str, task_id: str) -> list[str]:
    """Files whose range of ids holds this one, the latest batch first: at most one of each batch."""
    files = spark.read.schema(_FILES).parquet(f"{table}/files")
    held = files.filter((F.col("low") <= task_id) & (F.col("high") >= task_id)).orderBy(F.desc("batch_id"), "file")
    return [f"{table}/completions/batch_id={row.batch_id}/{row.file}" for row in held.collect()]


def task_completions(spark: SparkSession, table: str, task_id: str) -> list[str | None]:
    """The completions of one task; KeyError if there is none.

    Files are opened one after the other, the latest batch first, until one holds the task; after
    `compact_task_table` there is one. In a file, statistics and Bloom filters leave row groups out.
    """
    for file in task_files(spark, table, task_id):
        rows = spark.read.schema("task_id string, completions array<string>").parquet(file)
        found = rows.filter(F.col("task_id") == task_id).first()
        if found is not None:
            return found.completions
    raise KeyError(f"Task {task_id} not found")


def compact_task_table(spark: SparkSession, table: str, target: str, tasks_per_file: int = TASKS_PER_FILE) -> None:
    """Writes each task once to `target`, a table of one batch in which ranges of files do not overlap.

    The old table stays; readers turn to the new one once it is whole.
    """
    last = spark.read.schema(_FILES).parquet(f"{table}/files").agg(F.max("batch_id")).first()[0]
    tasks = read_task_table(spark, table).withColumn("status", F.lit("done"))
    write_task_batch(tasks, target, last or 0, tasks_per_file)


def export_tasks(ids: DataFrame, table: str, folder: str) -> bool:
    """The completions of chosen tasks (`task_id`) as one directory of JSON for each; False if there is no folder.

    An id asked for more than once is exported once; one that the table does not hold is left out.
    """
    chosen = read_task_table(ids.sparkSession, table).join(ids.select("task_id").distinct(), "task_id", "left_semi")
    return save_task_completions(chosen.withColumn("status", F.lit("done")), folder)
