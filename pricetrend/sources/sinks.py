"""Durable sinks for indicator and trend panels."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_panel(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet, partitioned by symbol so later reads prune to one series."""
    df.write.mode(mode).partitionBy("symbol").parquet(path)
