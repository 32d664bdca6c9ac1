from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import topn_share, topn_share_sql


def test_share_text_vs_number_rounding(spark):
    # 1 of 800 = 0.125 %: text rounds half-even, number half-up.
    data = [(2020, "A")] * 799 + [(2020, "B")]
    df = spark.createDataFrame(data, "year int, cat string")
    num = {r["cat"]: r["share"] for r in topn_share(df, "year", "cat").collect()}
    txt = {r["cat"]: r["share"] for r in topn_share(df, "year", "cat", as_text=True).collect()}
    assert num["B"] == 0.13 and txt["B"] == "0.12"


def test_top3_ties_by_name_and_total_over_all(spark):
    data = [(1, "d")] * 5 + [(1, "c")] * 3 + [(1, "a")] * 3 + [(1, "b")] * 3 + [(2, "z")]
    df = spark.createDataFrame(data, "year int, cat string")
    out = rows(topn_share(df, "year", "cat", n=3))
    assert out == [(1, "a", 3, 21.43), (1, "b", 3, 21.43), (1, "d", 5, 35.71), (2, "z", 1, 100.0)]


def test_weighted_equals_unweighted(spark):
    data = [(1, "a"), (1, "a"), (1, "b"), (2, "a")]
    df = spark.createDataFrame(data, "year int, cat string")
    pre = df.groupBy("year", "cat").agg(F.count(F.lit(1)).alias("w"))
    assert rows(topn_share(pre, "year", "cat", weight_col="w")) == rows(topn_share(df, "year", "cat"))


def test_sql_form_inner_join_drops_unknown(spark):
    recs = spark.createDataFrame(
        [(2020, "H"), (2020, "H"), (2020, "W"), (2020, None), (2020, "Q"), (2021, "W")],
        "year int, code string",
    )
    lookup = spark.createDataFrame([("H", "Hispanic"), ("W", "White")], "code string, full string")
    out = topn_share_sql(spark, recs, lookup, "code", "code", "r.year", "full")
    assert rows(out) == [(2020, "Hispanic", 2, 66.67), (2020, "White", 1, 33.33), (2021, "White", 1, 100.0)]
    df_form = recs.join(lookup, "code").select("year", F.col("full"))
    assert rows(topn_share(df_form, "year", "full")) == rows(out)


def test_rank_uses_window_group_limit(spark):
    data = [(1, f"c{i % 50}") for i in range(500)]
    df = spark.createDataFrame(data, "year int, cat string")
    out = topn_share(df, "year", "cat")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sum(r["cnt"] for r in out.collect()) == 30


def test_matches_pandas_on_random_data(spark):
    import random

    import pandas as pd

    rnd = random.Random(9)
    data = [
        (rnd.choice([2019, 2020, 2021, None]), rnd.choice(["a", "b", "c", "d", "e", None]))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(data, "year int, cat string")
    pdf = pd.DataFrame(data, columns=["year", "cat"])
    counts = pdf.groupby(["year", "cat"], dropna=False).size().reset_index(name="cnt")
    totals = counts.groupby("year", dropna=False)["cnt"].sum().rename("total").reset_index()
    counts = counts.merge(totals, on="year", how="left")
    # rank: count desc, then category asc with NULL first (Spark's ascending order)
    counts["cat_key"] = counts["cat"].fillna("")
    counts["null_first"] = counts["cat"].notna()
    for n in (1, 2, 3):
        want = set()
        for _, g in counts.groupby("year", dropna=False):
            g = g.sort_values(["cnt", "null_first", "cat_key"], ascending=[False, True, True]).head(n)
            for r in g.itertuples():
                y = None if pd.isna(r.year) else int(r.year)
                c = None if pd.isna(r.cat) else r.cat
                want.add((y, c, int(r.cnt), round(r.cnt / r.total * 100, 2)))
        got = {tuple(r) for r in topn_share(df, "year", "cat", n=n).collect()}
        assert got == want
