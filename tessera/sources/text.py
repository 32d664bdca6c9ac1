"""Plain text: one row per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of text file(s) as a single ``value`` column (splittable scan)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(paths)


def text_lines(df: DataFrame, text_col: str, out_col: str = "value") -> DataFrame:
    """Every line of every text in ``text_col`` as its own row (whole texts,
    all lines); the line break is ``\\n``."""
    return df.select(F.explode(F.split(F.col(text_col), "\n")).alias(out_col))
