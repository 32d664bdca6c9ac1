from pyspark.sql import types as T

from conftest import rows
from tessera.operators import band_counts, band_counts_udf

SCHEMA = T.StructType(
    [T.StructField("age", T.IntegerType()), T.StructField("desc", T.StringType())]
)


def _records(spark):
    data = [
        (17, "AGGRAVATED ASSAULT X"),
        (18, "AGGRAVATED ASSAULT"),
        (24, "AGGRAVATED ASSAULT"),
        (25, "x AGGRAVATED ASSAULT"),
        (64, "AGGRAVATED ASSAULT"),
        (65, "AGGRAVATED ASSAULT"),
        # dropped: bad age or description
        (None, "AGGRAVATED ASSAULT"),
        (0, "AGGRAVATED ASSAULT"),
        (-1, "AGGRAVATED ASSAULT"),
        (30, None),
        (30, ""),
        (30, "THEFT"),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_band_edges_and_filters(spark):
    out = band_counts(_records(spark), "age", "desc", "AGGRAVATED ASSAULT")
    assert rows(out) == [("Adults", 2), ("Children", 1), ("Elderly", 1), ("Young Adults", 2)]
    # most frequent first, ties by label
    assert [r["band"] for r in out.collect()] == ["Adults", "Young Adults", "Children", "Elderly"]


def test_udf_form_equals_native(spark):
    df = _records(spark)
    assert rows(band_counts_udf(df, "age", "desc", "AGGRAVATED ASSAULT")) == rows(
        band_counts(df, "age", "desc", "AGGRAVATED ASSAULT")
    )


def test_native_plan_has_no_python(spark):
    plan = band_counts(_records(spark), "age", "desc", "ASSAULT")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_native_and_pandas_banding_agree(spark):
    import pandas as pd

    from tessera.functions import band_expr, band_labels_pandas

    custom = (("low", None, 9), ("mid", 10, 19), ("high", 20, None))
    values = list(range(-5, 130)) + [None]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    for bands in (None, custom):
        kw = {} if bands is None else {"bands": bands}
        native = [r[0] for r in df.select(band_expr("v", **kw)).collect()]
        series = band_labels_pandas(pd.Series(values, dtype="float64"), **kw)
        assert native == list(series)


def test_fractional_values_between_bands(spark):
    df = spark.createDataFrame([(17.5,), (24.5,), (64.5,), (18.0,)], "v double")
    want = [("Children", 1), ("Elderly", 2), ("Young Adults", 1)]
    assert rows(band_counts(df, "v")) == want == rows(band_counts_udf(df, "v"))
