from conftest import rows
from tessera.sources import RECORD_COLUMNS, read_csv_columns, read_lines, text_lines


def test_two_record_files_read_as_one(spark, tmp_path):
    hdr = "DR_NO,DATE OCC,Vict Age,Vict Descent,Crm Cd Desc,Mocodes,LAT,LON\n"
    (tmp_path / "a.csv").write_text(hdr + '1,2019 Jan 01 01:00:00 PM,30,H,AGGRAVATED ASSAULT,0913 1814,34.0,-118.2\n')
    (tmp_path / "b.csv").write_text(hdr + "2,01/02/2021 01:10:00 PM,abc,W,THEFT,,0,0\n")
    df = read_csv_columns(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], RECORD_COLUMNS)
    got = rows(df, "Vict Age", "Vict Descent", "LAT")
    assert got == [(None, "W", 0.0), (30, "H", 34.0)]  # "abc" age -> NULL, not an error


def test_semicolon_csv_and_text(spark, tmp_path):
    (tmp_path / "i.csv").write_text('Zip Code;Estimated Median Income\n90001;"$12,345"\n90002;-\n')
    df = read_csv_columns(spark, str(tmp_path / "i.csv"), {"Zip Code": "string", "Estimated Median Income": "string"}, sep=";")
    assert rows(df) == [("90001", "$12,345"), ("90002", "-")]
    (tmp_path / "t.txt").write_text("0100 A\n0200 B\n")
    assert rows(read_lines(spark, str(tmp_path / "t.txt"))) == [("0100 A",), ("0200 B",)]
    texts = spark.createDataFrame([("a\nb",), ("c",)], "text string")
    assert rows(text_lines(texts, "text")) == [("a",), ("b",), ("c",)]


def test_positional_schema_reader(spark, tmp_path):
    from pyspark.sql import types as T

    from tessera.sources import read_csv_schema

    (tmp_path / "s.csv").write_text("X,Y,DIVISION\n-118.0,34.0,Alpha\nbad,34.1,Bravo\n")
    schema = T.StructType(
        [T.StructField("X", T.DoubleType()), T.StructField("Y", T.DoubleType()), T.StructField("DIVISION", T.StringType())]
    )
    assert rows(read_csv_schema(spark, str(tmp_path / "s.csv"), schema)) == [(None, 34.1, "Bravo"), (-118.0, 34.0, "Alpha")]


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    import pytest

    from tessera.sources.csv import read_csv_columns, read_csv_rejects

    (tmp_path / "a.csv").write_text("A,B\n1,x\n2,y\n")
    (tmp_path / "b.csv").write_text('B,more,A\nz,"q, r",3\nw,,4\n')
    (tmp_path / "c.csv").write_text("A,B\n5,v\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv")]
    want = {"A": "int", "B": "string"}
    assert rows(read_csv_columns(spark, paths, want)) == [(1, "x"), (2, "y"), (3, "z"), (4, "w"), (5, "v")]
    assert read_csv_columns(spark, paths[:1], {"B": "string"}).collect()[0]["B"] == "x"
    with pytest.raises(ValueError, match="more"):
        read_csv_columns(spark, paths, {"more": "string"})
    (tmp_path / "d.csv").write_text("A,B\n6,u\n7\n8,t,extra\nbad,s\n")
    d = str(tmp_path / "d.csv")
    assert rows(read_csv_columns(spark, d, want), "B") == [(None,), ("s",), ("t",), ("u",)]
    bad = read_csv_rejects(spark, [*paths, d], want)
    assert rows(bad, "record", "reason") == [("7", "fields"), ("8,t,extra", "fields"), ("bad,s", "type")]
    assert all(r["file"].endswith("d.csv") for r in bad.collect())


def _random_value(rnd, depth=0):
    kind = rnd.randrange(6 if depth < 3 else 4)
    if kind < 2:
        return "".join(rnd.choice('a"\\{}[],:é\n ') for _ in range(rnd.randrange(9)))
    if kind < 4:
        return rnd.choice([1, -2.5, None, True])
    if kind == 4:
        return [_random_value(rnd, depth + 1) for _ in range(rnd.randrange(3))]
    return {rnd.choice(["k", "}", '"', "type"]) + str(i): _random_value(rnd, depth + 1) for i in range(rnd.randrange(3))}


def test_elements_of_a_split_file_equal_the_whole_read(spark, tmp_path):
    import json
    import random

    from tessera.sources.split import json_elements

    rnd = random.Random(6)
    want = []
    for n in range(3):
        feats = [{"n": f"{n}.{i}", "v": _random_value(rnd)} for i in range(120)]
        feats.append({"n": f"{n}.long", "v": "}{" * 3000 + "\\\\\""})
        doc = {"name": 'x "{[', "type": "FeatureCollection", "features": feats, "bbox": [1, 2]}
        (tmp_path / f"{n}.json").write_text(json.dumps(doc, indent=rnd.choice([None, 1]), ensure_ascii=n == 1), encoding="utf-8")
        want += feats
    key = "spark.sql.files.maxPartitionBytes"
    for size in ("97", "1001", "10m"):
        spark.conf.set(key, size)
        try:
            df = json_elements(spark, str(tmp_path))
            got = [json.loads(r["json"]) for r in df.collect()]
        finally:
            spark.conf.unset(key)
        assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want))


def test_one_collection_file_is_read_by_many_tasks(spark, tmp_path):
    from tessera.sources.geojson import read_features
    from tessera.sources.split import _cut  # noqa: F401

    ring = "[[" + ",".join(f"[{i}.25,{i % 7}.5]" for i in range(300)) + "]]"
    one = '{"properties":{"n":"%d }{ \\" "},"geometry":{"type":"Polygon","coordinates":' + ring + '},"type":"Feature"}'
    n = 17_000  # 64 MB
    with open(tmp_path / "big.geojson", "w") as f:
        f.write('{"type":"FeatureCollection","features":[\n')
        f.writelines((",\n" if i else "") + one % i for i in range(n))
        f.write("\n]}\n")
    assert (tmp_path / "big.geojson").stat().st_size > 60 << 20
    key, path = "spark.sql.files.maxPartitionBytes", str(tmp_path / "big.geojson")
    got = {}
    for size in ("8m", "200m"):
        spark.conf.set(key, size)
        try:
            df = read_features(spark, path, {"n": "string"})
            got[size] = [(r["n"], r["s"]) for r in df.selectExpr("n", "length(coordinates) s").collect()]
            tasks = spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions()
            assert (tasks > 4) == (size == "8m")
        finally:
            spark.conf.unset(key)
    assert sorted(got["8m"]) == sorted(got["200m"]) and len(got["8m"]) == n
    assert {x for x, _ in got["8m"]} == {f'{i} }}{{ " ' for i in range(n)}


def test_layout_is_taken_from_the_file(spark, tmp_path):
    from tessera.sources.geojson import read_features

    f = '{"type": "Feature","properties":{"n":"a"},"geometry":{"type":"Polygon","coordinates":[]}}'
    (tmp_path / "lines.json").write_text(f + "\n" + f + "\n")
    (tmp_path / "coll.json").write_text('{"type":"FeatureCollection","features":[' + f + "]}")
    assert read_features(spark, str(tmp_path / "lines.json"), {"n": "string"}).count() == 2
    assert read_features(spark, str(tmp_path / "coll.json"), {"n": "string"}).count() == 1


def test_rejects_are_counted_with_the_rows(spark):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from tessera.sources.rejects import count_rejects

    df = spark.createDataFrame([(1, "a"), (None, "b"), (-1, None)], "n int, t string")
    seen = Observation("seen")
    out = count_rejects(df, {"no_n": F.col("n").isNull() | (F.col("n") <= 0), "no_t": F.col("t").isNull()}, seen)
    assert out.filter("n > 0").collect() == [(1, "a")]
    assert seen.get == {"rows": 3, "no_n": 2, "no_t": 1}


def test_sql_defined_functions_equal_the_expressions(spark):
    from pyspark.sql import functions as F

    from tessera.functions import band_expr, polygon_contains, sphere_distance_m
    from tessera.functions.sql import register_functions

    register_functions(spark)
    square = [(0.0, 0.0, 4.0, 0.0), (4.0, 0.0, 4.0, 4.0), (4.0, 4.0, 0.0, 4.0), (0.0, 4.0, 0.0, 0.0)]
    data = [(float(x), float(y), square) for x in range(-1, 6) for y in (-1, 0, 2, 4, 17.5, 24.5, 70)]
    df = spark.createDataFrame(data, "x double, y double, edges array<struct<ax:double,ay:double,bx:double,by:double>>")
    df.createOrReplaceTempView("sql_function_rows")
    got = spark.sql(
        "SELECT x, y, age_band(y) a, sphere_distance_m(x, y, y, x) d, zone_contains(edges, x, y) c FROM sql_function_rows"
    )
    want = df.select(
        "x", "y", band_expr("y").alias("a"), sphere_distance_m("x", "y", "y", "x").alias("d"),
        polygon_contains("edges", F.col("x"), F.col("y")).alias("c"),
    )
    assert rows(got) == rows(want)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_wrong_geojson_layout_fails(spark, tmp_path):
    import pytest

    from tessera.sources.geojson import read_features

    f = '{"type":"Feature","properties":{"n":"a"},"geometry":{"type":"Polygon","coordinates":[]}}'
    (tmp_path / "lines.json").write_text(f + "\n" + f + "\n")
    (tmp_path / "coll.json").write_text('{"type":"FeatureCollection","features":[' + f + "]}")
    good = {"lines": "lines.json", "collection": "coll.json"}
    for layout, name in good.items():
        assert read_features(spark, str(tmp_path / name), {"n": "string"}, layout).count() >= 1
    for layout, name in (("lines", "coll.json"), ("collection", "lines.json")):
        with pytest.raises(Exception, match="layout"):
            read_features(spark, str(tmp_path / name), {"n": "string"}, layout).collect()
