"""Result sinks (SNK1; SNK2 lives with the models)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_answers_json(df: DataFrame, path: str) -> None:
    """SNK1: parsed predictions as JSON lines (one object per row), overwrite."""
    df.write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
