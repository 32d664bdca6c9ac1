import pytest

from conftest import rows
from tessera.operators import code_frequency, explode_codes, parse_code_dictionary


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_strict_and_lenient_dictionary(spark):
    lines = _lines(spark, ["0100 Suspect A", "0100 Suspect B", "0200   Two  spaces ", "0300", "  0400 lead", ""])
    strict = rows(parse_code_dictionary(lines))
    assert strict == [("0100", "Suspect A"), ("0200", "Two  spaces ")]
    lenient = rows(parse_code_dictionary(lines, lenient=True))
    assert lenient == [("0100", "Suspect A"), ("0200", "Two  spaces"), ("0300", ""), ("0400", "lead")]


def test_code_lists_and_joins(spark):
    recs = spark.createDataFrame([(" 0913  1814 ",), ("0913",), ("",), (None,), ("9999",)], "m string")
    codes = explode_codes(recs, "m")
    assert rows(codes) == [("0913",), ("0913",), ("1814",), ("9999",)]
    d = parse_code_dictionary(_lines(spark, ["0913 Victim known", "1814 Domestic"]))
    left = rows(code_frequency(codes, d))
    assert left == [("0913", "Victim known", 2), ("1814", "Domestic", 1), ("9999", "9999", 1)]
    inner = rows(code_frequency(codes, d, how="inner"))
    assert inner == [("0913", "Victim known", 2), ("1814", "Domestic", 1)]


@pytest.mark.parametrize(
    "hint,op",
    [
        ("broadcast", "BroadcastHashJoin"),
        ("merge", "SortMergeJoin"),
        ("shuffle_hash", "ShuffledHashJoin"),
    ],
)
def test_join_hints_pick_strategy(spark, hint, op):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        codes = explode_codes(spark.createDataFrame([("a b a",)], "m string"), "m")
        d = parse_code_dictionary(_lines(spark, ["a first", "b second"]))
        df = code_frequency(codes, d, join_hint=hint)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert op in plan
        assert rows(df) == [("a", "first", 2), ("b", "second", 1)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_replicate_nl_hint_ignored_for_left_join(spark):
    codes = explode_codes(spark.createDataFrame([("a b a",)], "m string"), "m")
    d = parse_code_dictionary(_lines(spark, ["a first"]))
    df = code_frequency(codes, d, join_hint="shuffle_replicate_nl")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert rows(df) == [("a", "first", 2), ("b", "b", 1)]


def test_hot_code_is_summed_before_the_shuffle(spark):
    # One code holds far more than a third of all tokens.
    recs = spark.createDataFrame([("0913 " * 50 + "1814",)] * 40 + [("2000",)], "m string")
    d = parse_code_dictionary(_lines(spark, ["0913 Hot"]))
    df = code_frequency(explode_codes(recs, "m"), d)
    assert rows(df) == [("0913", "Hot", 2000), ("1814", "1814", 40), ("2000", "2000", 1)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    # partial aggregate sits below the exchange that groups by code
    assert "partial_count" in plan


def test_broadcast_hint_needs_a_small_dictionary(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        codes = explode_codes(spark.createDataFrame([("a b a",)], "m string"), "m")
        d = parse_code_dictionary(_lines(spark, ["a first", "b second"]))
        ok = code_frequency(codes, d, join_hint="broadcast")
        assert "BroadcastHashJoin" in ok._jdf.queryExecution().executedPlan().toString()
        big = code_frequency(codes, d, join_hint="broadcast", max_broadcast_rows=1)
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert rows(big) == rows(ok)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
