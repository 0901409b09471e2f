"""Checks made before a job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def require_rows(df: DataFrame, name: str = "dataset") -> DataFrame:
    """The same rows; an empty dataset raises. Reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"Dataset {name} is empty")
    return df


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows; a missing column raises before anything is read."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Column(s) {', '.join(missing)} not found, the dataset has {', '.join(df.columns)}")
    return df
