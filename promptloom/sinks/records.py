"""Lineage and parameter records written as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_lineage(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)


def append_params(routed: DataFrame, path: str) -> None:
    """Parameters and long texts under `route=param` and `route=text`."""
    routed.write.mode("append").partitionBy("route").parquet(path)


def append_records(records: tuple[DataFrame, DataFrame], folder: str) -> None:
    """A job's lineage and parameters, each in its table of the folder."""
    append_lineage(records[0], f"{folder}/lineage")
    append_params(records[1], f"{folder}/params")
