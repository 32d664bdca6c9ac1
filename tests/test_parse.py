from pyspark.sql import functions as F

from conftest import rows
from tessera.functions import parse_currency, parse_timestamp_any, render_currency


def test_two_date_layouts_and_junk(spark):
    df = spark.createDataFrame(
        [("2020 Jan 02 01:10:00 PM",), ("01/02/2021 01:10:00 PM",), ("junk",), (None,)], "d string"
    )
    out = df.select(F.year(parse_timestamp_any("d")).alias("y"))
    assert [r["y"] for r in out.collect()] == [2020, 2021, None, None]


def test_currency(spark):
    df = spark.createDataFrame([("$12,345",), ("-",), (None,), ("$1,234.50",)], "t string")
    assert [r["v"] for r in df.select(parse_currency("t").alias("v")).collect()] == [12345.0, None, None, 1234.5]
    back = spark.createDataFrame([(4512.07,)], "v double").select(render_currency("v").alias("t"))
    assert rows(back) == [("$4,512.07",)]
