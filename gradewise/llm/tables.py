"""Intermediate tables in the shared scratch folder: they cut lineage and outlive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gradewise.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as written to a new table of the shared scratch folder and read again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
