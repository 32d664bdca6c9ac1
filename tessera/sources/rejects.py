"""Counts of the rows that cleaning rules turn away, without a second scan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def count_rejects(df: DataFrame, rules: Mapping[str, Column], seen: Observation) -> DataFrame:
    """``df`` unchanged; once an action has run over it, ``seen.get`` has its
    number of ``rows`` and for each rule the rows for which it is true.

    The counts are summed in the tasks that read the rows anyway.  Set it
    before the filters whose rejects it counts; a row may fall under several
    rules.
    """
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
