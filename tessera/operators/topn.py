"""Top-n categories per group with each one's share of the group total."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def topn_share(
    df: DataFrame,
    group_col: str,
    category_col: str,
    n: int = 3,
    weight_col: str | None = None,
    count_col: str = "cnt",
    share_col: str = "share",
    as_text: bool = False,
) -> DataFrame:
    """Per ``group_col``: the ``n`` largest categories, their count and percentage share.

    ``df`` holds one row per record, or pre-aggregated rows with their
    multiplicity in ``weight_col`` (aggregate before a join to shrink the
    shuffle and absorb hot keys).  The share is of the group's total over all
    categories.  Ties in count are broken by category so results are
    deterministic.  ``as_text`` renders the share with two decimals
    (``format_number``, half-even); otherwise it is a double rounded half-up.

    Plan: one aggregate (partial + final) by (group, category).  Group
    totals come from a second, tiny aggregate of those counts, not from an
    unordered window, so no task ever holds all categories of a group: the
    rank filter is pushed into the window as a group limit, applied before
    the shuffle (each task keeps at most ``n`` rows per group) and again
    after it.  The totals (one row per group) are joined back at the end.
    """
    measure = F.count(F.lit(1)) if weight_col is None else F.sum(weight_col)
    counts = df.groupBy(group_col, category_col).agg(measure.cast("long").alias(count_col))
    totals = counts.groupBy(F.col(group_col).alias("_g")).agg(F.sum(count_col).alias("_total"))
    ranked = Window.partitionBy(group_col).orderBy(F.col(count_col).desc(), F.col(category_col))
    top = counts.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= n)
    pct = F.try_divide(F.col(count_col), F.col("_total")) * 100
    return top.join(totals, top[group_col].eqNullSafe(totals["_g"])).select(
        group_col,
        category_col,
        count_col,
        (F.format_number(pct, 2) if as_text else F.round(pct, 2)).alias(share_col),
    )


def topn_share_sql(
    spark: SparkSession,
    records: DataFrame,
    lookup: DataFrame,
    record_key: str,
    lookup_key: str,
    group_expr: str,
    category_col: str,
    n: int = 3,
    view_prefix: str = "tessera",
) -> DataFrame:
    """The same analysis as one SQL statement with chained CTEs
    (join -> group -> totals and ranks -> join) over two temporary views.

    ``group_expr`` is a SQL expression over the records (e.g. ``year(ts)``).
    Output columns: group, category, cnt, share (double, half-up).
    """
    rv, lv = f"{view_prefix}_records", f"{view_prefix}_lookup"
    records.createOrReplaceTempView(rv)
    lookup.createOrReplaceTempView(lv)
    return spark.sql(
        f"""
        WITH joined AS (
            SELECT {group_expr} AS grp, l.`{category_col}` AS category
            FROM {rv} r JOIN {lv} l ON r.`{record_key}` = l.`{lookup_key}`
        ),
        grouped AS (
            SELECT grp, category, COUNT(*) AS cnt FROM joined GROUP BY grp, category
        ),
        totals AS (
            SELECT grp, SUM(cnt) AS total FROM grouped GROUP BY grp
        ),
        ranked AS (
            SELECT grp, category, cnt,
                   ROW_NUMBER() OVER (PARTITION BY grp ORDER BY cnt DESC, category) AS rn
            FROM grouped
        )
        SELECT r.grp, r.category, r.cnt, ROUND(try_divide(r.cnt, t.total) * 100, 2) AS share
        FROM ranked r JOIN totals t ON r.grp <=> t.grp
        WHERE r.rn <= {int(n)}
        """
    )
