"""Aggregate expressions for correlation and moments, plus stable rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pearson(x: Column | str, y: Column | str) -> Column:
    """Population Pearson correlation over the complete (x, y) pairs.

    NULL when fewer than two pairs or when either variance is not positive,
    instead of a division error (``corr`` raises on a constant column under
    ANSI mode).
    """
    x, y = _col(x), _col(y)
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    n = F.count(F.when(both, F.lit(1)))
    vx, vy = F.var_pop(xs), F.var_pop(ys)
    return F.when(
        (n > 1) & (vx > 0) & (vy > 0), F.covar_pop(xs, ys) / F.sqrt(vx * vy)
    )


def round_sig(c: Column | str, digits: int = 9) -> Column:
    """Round to ``digits`` significant digits (0 stays 0, NULL stays NULL).

    Used on sums of doubles, whose last bits depend on summation order, so
    that two engines' results compare equal.
    """
    v = _col(c)
    e = F.floor(F.log10(F.abs(v)))
    # Only exact powers of ten (10**k, k >= 0) are used, each step being one
    # correctly rounded operation, so every engine gets the same bits.
    scale = F.pow(F.lit(10.0), F.abs(e))
    up = F.round(v / scale, digits - 1) * scale
    down = F.round(v * scale, digits - 1) / scale
    return F.when(v == 0, F.lit(0.0)).when(e >= 0, up).otherwise(down)
