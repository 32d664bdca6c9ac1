"""Value bands: a list of (label, low, high) turned into one CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The age bands of the record analysis, in order.  A value below
# 18 is "Children", 18..24 "Young Adults", 25..64 "Adults", anything else
# "Elderly".  ``None`` marks an open end; the last band is the fallback.
AGE_BANDS: tuple[tuple, ...] = (
    ("Children", None, None, 18),
    ("Young Adults", 18, 24),
    ("Adults", 25, 64),
    ("Elderly", 65, None),
)

# (label, low, high) with inclusive bounds; a fourth member is a bound that the
# value stays below, for fractional values.
Band = tuple


def band_expr(value: Column | str, bands: Sequence[Band] = AGE_BANDS) -> Column:
    """CASE WHEN chain mapping ``value`` to the label of the first band holding it.

    Bands are checked in order; the last one is the ELSE branch, so a value
    outside every earlier band (24.5 of the age bands, say) lands there.
    """
    v = F.col(value) if isinstance(value, str) else value
    *head, last = bands
    expr = None
    for label, lo, hi, *below in head:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (v >= F.lit(lo))
        if hi is not None:
            cond = cond & (v <= F.lit(hi))
        if below:
            cond = cond & (v < F.lit(below[0]))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(last[0])
    return expr.otherwise(F.lit(last[0]))


def band_labels_pandas(values: pd.Series, bands: Sequence[Band] = AGE_BANDS) -> pd.Series:
    """Vectorised twin of :func:`band_expr` for a pandas batch (used by the UDF form)."""
    v = values.to_numpy(dtype="float64", na_value=np.nan)
    *head, last = bands
    conds = []
    for _label, lo, hi, *below in head:
        c = np.ones(len(v), dtype=bool)
        if lo is not None:
            c &= v >= lo
        if hi is not None:
            c &= v <= hi
        if below:
            c &= v < below[0]
        conds.append(c)
    out = np.select(conds, [b[0] for b in head], default=last[0]) if head else np.full(len(v), last[0])
    return pd.Series(out, index=values.index, dtype="object")
