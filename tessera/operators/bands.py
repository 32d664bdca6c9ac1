"""Count records per value band after null/text filters."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import bands as _bands_module
from tessera.functions.bands import AGE_BANDS, Band, band_expr, band_labels_pandas

# Executors need not have this package installed: the band helper the UDF
# calls is shipped inside the pickled UDF itself.
cloudpickle.register_pickle_by_value(_bands_module)


def _filtered(df: DataFrame, value_col: str, text_col: str | None, contains: str | None) -> DataFrame:
    cond = F.col(value_col).isNotNull() & (F.col(value_col) > 0)
    if text_col is not None:
        cond = cond & F.col(text_col).isNotNull() & (F.col(text_col) != "")
        if contains is not None:
            cond = cond & F.col(text_col).contains(contains)
    return df.filter(cond)


def band_counts(
    df: DataFrame,
    value_col: str,
    text_col: str | None = None,
    contains: str | None = None,
    bands: Sequence[Band] = AGE_BANDS,
    band_col: str = "band",
    count_col: str = "cnt",
) -> DataFrame:
    """Rows per band of ``value_col``, most frequent first.

    Keeps rows whose value is non-null and positive and, when ``text_col`` is
    given, whose text is non-empty (and holds ``contains``).  The band is one
    CASE expression, so the scan, filter, banding and partial count fuse into
    one code-generated stage; only (band, partial count) pairs are shuffled.
    """
    out = (
        _filtered(df, value_col, text_col, contains)
        .groupBy(band_expr(value_col, bands).alias(band_col))
        .agg(F.count(F.lit(1)).alias(count_col))
    )
    return out.orderBy(F.col(count_col).desc(), F.col(band_col))


def band_counts_udf(
    df: DataFrame,
    value_col: str,
    text_col: str | None = None,
    contains: str | None = None,
    bands: Sequence[Band] = AGE_BANDS,
    band_col: str = "band",
    count_col: str = "cnt",
) -> DataFrame:
    """Same result through a vectorised (Arrow batch) pandas UDF.

    For band rules that cannot be written as column expressions; the built-in
    form above is the one to use when they can.
    """
    bands = tuple(bands)

    @F.pandas_udf("string")
    def to_band(values: pd.Series) -> pd.Series:
        return band_labels_pandas(values, bands)

    out = (
        _filtered(df, value_col, text_col, contains)
        .select(to_band(F.col(value_col)).alias(band_col))
        .groupBy(band_col)
        .agg(F.count(F.lit(1)).alias(count_col))
    )
    return out.orderBy(F.col(count_col).desc(), F.col(band_col))
