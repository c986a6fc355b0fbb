"""Parquet sinks for the raw, clean and curated layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                only_partitions: bool = False) -> None:
    """Write snappy Parquet; a rerun replaces its own data and never doubles it.

    ``only_partitions`` replaces just the partition directories that ``df`` has
    rows for and leaves all others as they are.
    """
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
