"""Rows numbered 0, 1, 2, … without passing them through one task."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptloom.session import shared_folder

ROW_ID = "row_id"

# Bytes of a table that may be broadcast; a larger one is joined as Spark sees fit.
MAX_BROADCAST_BYTES = 32 << 20


def number_by_key(df: DataFrame, key: str, buckets: int | None = None, name: str = ROW_ID) -> DataFrame:
    """Rows numbered in the order of a unique numeric key.

    Quantiles of the key, from one pass over that column, cut it into ranges of about equal
    size. Rows are numbered within their range, and the ranges' counts (one row each) are
    broadcast to give each range its start. A range depends on the key alone, so a task that
    runs again numbers its rows the same way.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = [i / buckets for i in range(1, buckets)]
    bounds = df.agg(F.percentile_approx(key, share, F.lit(100 * buckets))).first()[0] if share else []
    ranged = df.withColumn("_range", _range_of(F.col(key), sorted(set(bounds or []))))
    running = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_start"))
    )
    within = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    return (
        ranged.withColumn("_within", within)
        .join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + F.col("_within"))
        .drop("_range", "_within", "_start")
    )


def number_by_scan(df: DataFrame, name: str = ROW_ID) -> DataFrame:
    """Rows of a file scan numbered in the order of their files and lines. `df` must be the scan itself.

    A Parquet row knows its number within its file, however the file is split, so that only each
    file's start has to be added: counts come from one pass over no columns, one row per file, as
    many as the driver lists for any scan. In other formats a row knows no number, so the scan is
    written once to the shared folder with each row's place in its block of a file; counts of blocks,
    a row each, are added up in the order of files and blocks. Either way the numbers do not depend
    on how the scan is split. A file without a start raises.
    """
    try:
        tagged = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return _number_by_block(df, name)
    counts = {row["_file"]: row["count"] for row in tagged.groupBy("_file").count().collect()}
    starts, total = [], 0
    for file in sorted(counts):
        starts.append((file, total))
        total += counts[file]
    side = df.sparkSession.createDataFrame(starts, "_file string, _start bigint")
    joined = tagged.join(bounded_broadcast(side, sum(len(file) + 24 for file in counts)), "_file", "left")
    lost = F.raise_error(F.concat(F.lit("No row was counted in "), F.col("_file"))).cast("bigint")
    return joined.withColumn(name, F.coalesce(F.col("_start"), lost) + F.col("_row")).drop("_file", "_row", "_start")


def _number_by_block(df: DataFrame, name: str) -> DataFrame:
    """Rows numbered by file, block and place in the block; without files, by partition and place."""
    spark, place = df.sparkSession, F.monotonically_increasing_id().alias("_place")
    try:
        placed = df.select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), place
        )
    except AnalysisException:
        placed = df.select("*", F.lit("").alias("_file"), F.spark_partition_id().cast("bigint").alias("_block"), place)
    folder = f"{shared_folder(spark)}/{uuid.uuid4()}"
    placed.write.parquet(folder)
    rows = spark.read.schema(placed.schema).parquet(folder)
    # Rows of a block are read one after the other by one task, so their places follow each other.
    blocks = rows.groupBy("_file", "_block").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    number = F.col("_start") + F.col("_place") - F.col("_first")
    return rows.join(starts, ["_file", "_block"]).select(*df.columns, number.alias(name))


def bounded_broadcast(side: DataFrame, size: int) -> DataFrame:
    """A table of that many bytes with a hint to broadcast it, if they are few enough."""
    return F.broadcast(side) if size <= MAX_BROADCAST_BYTES else side


def _range_of(key: Column, bounds: list) -> Column:
    """How many bounds lie at or below the key, looked up in two steps of about √n comparisons."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    every = F.array(*[F.lit(b) for b in bounds])
    coarse = F.array(*[F.lit(b) for b in bounds[step - 1 :: step]])
    skipped = F.size(F.filter(coarse, lambda b: b <= key)) * step
    return skipped + F.size(F.filter(F.slice(every, skipped + 1, F.lit(step)), lambda b: b <= key))
