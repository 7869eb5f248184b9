"""Readers for the driver's parquet tables and size-checked broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of ``{sf_dir}/{name}.parquet``; Catalyst prunes columns."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows.

    Counts with one cheap action (no columns are decoded for a plain scan; each
    task sends one partial count).
    Beyond the bound the frame is returned as is and the planner picks a
    shuffle join, so a dimension that grows with the data never lands whole
    on every executor.
    """
    return F.broadcast(df) if df.count() <= max_rows else df
