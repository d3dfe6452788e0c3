"""Versioned table writes (K7): a new version is written beside the old one, never over it,
so readers of the old version are not disturbed and a failed write leaves nothing half-done."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_version(df: DataFrame, root: str) -> str:
    """Write ``df`` as parquet to a fresh ``root/v=<id>`` folder and return its path."""
    path = f"{root.rstrip('/')}/v={uuid.uuid4().hex[:16]}"
    df.write.mode("errorifexists").parquet(path)
    return path


def read_version(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` (shared storage) and return the table read back: later plans
    that use it several times read it instead of recomputing it, and lineage is cut there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
