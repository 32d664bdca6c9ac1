import json
import math
import random

from pyspark.sql import functions as F

from conftest import rows
from tessera.functions import polygon_contains, sphere_distance_m
from tessera.operators import points_in_zones, zones_from_geojson
from tessera.sources import read_features

SQUARE = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]]
HOLED = SQUARE + [[[1.0, 1.0], [3.0, 1.0], [3.0, 3.0], [1.0, 3.0], [1.0, 1.0]]]
MULTI = [[[[10.0, 0.0], [12.0, 0.0], [12.0, 2.0], [10.0, 0.0]]], [[[20.0, 0.0], [22.0, 0.0], [22.0, 2.0], [20.0, 2.0], [20.0, 0.0]]]]


def _zones(spark):
    data = [
        (1, "Polygon", json.dumps(SQUARE)),
        (2, "Polygon", json.dumps(HOLED)),
        (3, "MultiPolygon", json.dumps(MULTI)),
        (4, "Point", "[1.0, 1.0]"),
    ]
    return zones_from_geojson(spark.createDataFrame(data, "zid int, geom_type string, coordinates string"))


def test_distance_properties(spark):
    df = spark.createDataFrame([(-118.3, 34.0, -118.2, 34.1)], "a double, b double, c double, d double")
    r = df.select(
        sphere_distance_m("a", "b", "c", "d").alias("ab"),
        sphere_distance_m("c", "d", "a", "b").alias("ba"),
        sphere_distance_m("a", "b", "a", "b").alias("aa"),
        sphere_distance_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("deg"),
    ).collect()[0]
    assert abs(r["ab"] - r["ba"]) < 1e-6 and r["aa"] == 0.0
    assert abs(r["deg"] - 6371008.0 * math.pi / 180) < 1e-6
    assert 14000 < r["ab"] < 15000


def test_contains_rules(spark):
    z = _zones(spark)
    pts = spark.createDataFrame(
        [
            (1, 2.0, 0.5),   # inside square, inside holed outer ring but not in hole
            (2, 2.0, 2.0),   # square yes, holed: in the hole -> no
            (3, 4.0, 2.0),   # on the square's edge -> no
            (4, 0.0, 0.0),   # on a vertex -> no
            (5, 11.5, 0.5),  # first part of the multipolygon
            (6, 21.0, 1.0),  # second part
            (7, 15.0, 1.0),  # between parts
            (8, 1.0, 3.0),   # square yes; on the hole's edge -> no for holed
            (9, None, 1.0),  # missing coordinate
        ],
        "pid int, lon double, lat double",
    )
    hits = rows(points_in_zones(pts, z, "zid"), "pid", "zid")
    assert hits == [(1, 1), (1, 2), (2, 1), (5, 3), (6, 3), (8, 1)]


def test_grid_join_equals_brute_force(spark):
    rnd = random.Random(7)
    zones = []
    for i in range(40):
        cx, cy = rnd.uniform(-5, 5), rnd.uniform(-5, 5)
        r = rnd.choice([0.05, 0.3, 1.5, 6.0])  # mixed sizes -> several grid levels
        k = rnd.randint(3, 9)
        ring = [[cx + r * math.cos(2 * math.pi * j / k), cy + r * math.sin(2 * math.pi * j / k)] for j in range(k)]
        zones.append((i, "Polygon", json.dumps([ring + [ring[0]]])))
    z = zones_from_geojson(spark.createDataFrame(zones, "zid int, geom_type string, coordinates string"))
    pts = spark.createDataFrame(
        [(i, rnd.uniform(-8, 8), rnd.uniform(-8, 8)) for i in range(3000)], "pid int, lon double, lat double"
    )
    grid = rows(points_in_zones(pts, z, "zid"), "pid", "zid")
    brute = rows(
        pts.crossJoin(z.select("zid", "edges")).filter(polygon_contains("edges", "lon", "lat")), "pid", "zid"
    )
    assert grid == brute and len(grid) > 100
    plan = points_in_zones(pts, z, "zid")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # Same answer when the zone tables are too big to broadcast (shuffled joins).
    assert rows(points_in_zones(pts, z, "zid", max_broadcast_rows=0), "pid", "zid") == brute


def test_geojson_files(spark, tmp_path):
    feats = [
        {"type": "Feature", "properties": {"COMM": "A", "ZCTA20": 90001, "POP20": 10}, "geometry": {"type": "Polygon", "coordinates": SQUARE}},
        {"type": "Feature", "properties": {"COMM": "B", "ZCTA20": "90002", "POP20": 0}, "geometry": {"type": "MultiPolygon", "coordinates": MULTI}},
    ]
    coll = tmp_path / "c.geojson"
    coll.write_text(json.dumps({"type": "FeatureCollection", "features": feats}, indent=2))
    lines = tmp_path / "l.geojson"
    lines.write_text("\n".join(json.dumps(f) for f in feats))
    props = {"COMM": "string", "ZCTA20": "string", "POP20": "double"}
    for path, layout in ((str(coll), "collection"), (str(lines), "lines")):
        z = zones_from_geojson(read_features(spark, path, props, layout=layout))
        got = rows(z.select("COMM", "ZCTA20", "POP20", F.size("edges").alias("n")))
        assert got == [("A", "90001", 10.0, 4), ("B", "90002", 0.0, 7)]
