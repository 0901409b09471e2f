"""Completions made elsewhere, put back next to their rows."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptloom.constants import INFERENCE
from promptloom.operators.inference import with_completions
from promptloom.operators.positions import ROW_ID, number_by_key, number_by_scan

logger = logging.getLogger(__name__)


def merge_completions(
    data: DataFrame, completions: DataFrame, key: str | None = None, output_column: str = INFERENCE
) -> DataFrame:
    """Rows with the completion of the same position.

    Rows are in the order of a unique numeric `key`, or else of the files they are scanned
    from. `completions` has the columns `row_id`, the position from 0, and `completion`. If
    the two differ in number, only the completions are kept. Both are counted before rows are
    numbered, which for Parquet reads no data. Positions are unique, so no join key is hot.
    """
    if not isinstance(completions, DataFrame):
        raise TypeError(f"Completions must be a DataFrame, got {type(completions)}")
    n_data, n_completions = data.count(), completions.count()
    if n_data != n_completions:
        logger.error("Got %d completions for %d rows, keeping the completions alone", n_completions, n_data)
        return completions.select(F.col("completion").alias(output_column))
    logger.info("Got %d completions", n_completions)
    numbered = number_by_key(data, key) if key else number_by_scan(data)
    joined = numbered.join(completions.select(ROW_ID, F.col("completion").alias("_completion")), ROW_ID, "left")
    return with_completions(joined, F.col("_completion"), output_column).drop("_completion", ROW_ID)
