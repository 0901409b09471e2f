"""Completion requests as JSON files, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptloom.schemas import REQUEST


def read_requests(
    spark: SparkSession, folder: str, stream: bool = False, one_per_file: bool = False, max_files: int | None = None
) -> DataFrame:
    """Requests with `queued_at`, the time their file was written (the same if read again).

    A request is one line, or one file. Missing parameters are empty maps and null structs.
    """
    reader = spark.readStream if stream else spark.read
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    written = F.unix_micros(F.col("_metadata.file_modification_time")) / 1_000_000
    empty = F.create_map().cast("map<string, string>")
    return (
        reader.schema(REQUEST).option("multiLine", one_per_file).json(folder)
        .withColumn("sampling_params", F.coalesce(F.col("sampling_params"), empty))
        .withColumn("queued_at", written)
    )


def with_rejection(requests: DataFrame) -> DataFrame:
    """Requests with the `reason` they are not taken, null for those that are, and their `place`."""
    return requests.withColumn("place", F.monotonically_increasing_id()).withColumn(
        "reason",
        F.when(F.col("_corrupt_record").isNotNull(), "Malformed request")
        .when(F.col("prompts").isNull(), "Field required: prompts")
        .when(F.exists("prompts", lambda p: p.isNull()), "Prompts must be strings")
        .when(F.col("task_id").isNull(), "Field required: task_id"),
    )


def without_repeats(checked: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Requests that would be taken, but repeat an id before them or one of `earlier`, get a `reason` too.

    `place` numbers the rows of `checked`, which should be a written table, as it is read twice. The
    first of each id is found before anything is shuffled, and requests are shuffled by their place:
    neither one id sent very often nor very many malformed requests, whose id is null, make a hot key.
    """
    taken = F.col("reason").isNull()
    order = F.struct("queued_at", F.xxhash64("prompts", F.to_json("prompts_params")), "place")
    firsts = checked.filter(taken).groupBy("task_id").agg(F.min(order)["place"].alias("first_place"))
    if earlier is not None:
        firsts = firsts.join(earlier.select("task_id").distinct(), "task_id", "left_anti")
    firsts = firsts.select("first_place")
    again = taken & F.col("first_place").isNull()
    reason = F.when(again, "Repeated task id").otherwise(F.col("reason"))
    joined = checked.join(firsts, F.col("place") == F.col("first_place"), "left")
    return joined.withColumn("reason", reason).drop("place", "first_place")


def valid_requests(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason").isNull()).drop("reason", "_corrupt_record")


def rejected_requests(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason").isNotNull())
