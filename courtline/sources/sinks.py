"""Sinks: whole-object landing overwrite and full-refresh tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from courtline import session


def write_landed(df: DataFrame, path: str, partition_by=None) -> None:
    """Replace a landed extract as a whole, partitions that get no row included."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Full-refresh table: rebuilt whole on every run."""
    df.write.mode("overwrite").option("compression", session.codec(df.sparkSession)).parquet(path)


def save_table(df: DataFrame, name: str) -> None:
    """Full-refresh catalog table."""
    df.write.mode("overwrite").saveAsTable(name)
