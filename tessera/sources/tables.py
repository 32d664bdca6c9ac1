"""Parquet tables laid out as ``<dir>/<name>.parquet``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Columnar scan; filters and column pruning reach the parquet reader."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
