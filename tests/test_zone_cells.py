"""Clipped zone cells and counts through the join against whole edge lists."""

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_polygon_property import _edges, _star

from tessera.functions import polygon_contains
from tessera.operators import ZoneCells, clip_zones, count_points_in_zones, points_in_zones

SCHEMA = "zid int, edges array<struct<ax:double,ay:double,bx:double,by:double>>"


def make(spark, zones):
    return spark.createDataFrame([(i, [tuple(map(float, e)) for e in z]) for i, z in zones], SCHEMA)


def round_zone(n, cx, cy, r, wave):
    ring = [
        (cx + r * (1 + wave * math.sin(37 * t)) * math.cos(t), cy + r * (1 + wave * math.sin(37 * t)) * math.sin(t))
        for t in (2 * math.pi * j / n for j in range(n))
    ]
    return _edges([ring])


def integer_zones(rnd, n):
    """Zones on whole numbers: holes, parts, corners that touch, cells' own corners."""
    out = []
    for i in range(n):
        cx, cy = rnd.randrange(-8, 8), rnd.randrange(-8, 8)
        rings = [r for r in (_star(rnd, cx, cy, rnd.randint(3, 30), 1, 12) for _ in range(rnd.choice([1, 1, 2, 3]))) if r]
        if i % 4 == 0:  # two squares that share a corner, and one edge twice
            rings.append([(cx, cy), (cx + 4, cy), (cx + 4, cy + 4), (cx, cy + 4)])
            rings.append([(cx + 4, cy + 4), (cx + 8, cy + 4), (cx + 8, cy + 8), (cx + 4, cy + 8)])
        if rings:
            out.append((i, _edges(rings)))
    return out


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_clipped_cells_give_the_zones_own_verdict(spark, max_rows):
    rnd = random.Random(4)
    z = make(spark, integer_zones(rnd, 40) + [(99, []), (100, [(1, 1, 1, 1)])])
    pts = [(i, rnd.randrange(-160, 160) / 8, rnd.randrange(-160, 160) / 8) for i in range(2500)]
    p = spark.createDataFrame(pts + [(-1, None, 1.0)], "pid int, lon double, lat double")
    cells = ZoneCells(z, "zid", clip=True)
    got = rows(points_in_zones(p, cells, "zid", max_broadcast_rows=max_rows), "pid", "zid")
    want = rows(p.crossJoin(z).filter(polygon_contains("edges", "lon", "lat")), "pid", "zid")
    assert got == want and len(got) > 1000
    counted = rows(count_points_in_zones(p, cells, "zid", max_broadcast_rows=max_rows))
    per = {}
    for _, i in want:
        per[i] = per.get(i, 0) + 1
    assert counted == sorted(per.items())


def test_zones_of_ten_thousand_corners(spark):
    rnd = random.Random(8)
    zones = [(1, round_zone(10_000, 0.1, 0.2, 3.0, 0.2)), (2, round_zone(10_000, 1.0, -1.0, 0.01, 0.0)), (3, round_zone(5, 0, 0, 2, 0))]
    z = make(spark, zones)
    pts = [(i, rnd.uniform(-4, 4), rnd.uniform(-4, 4)) for i in range(400)]
    pts += [(400 + i, rnd.uniform(0.985, 1.015), rnd.uniform(-1.015, -0.985)) for i in range(400)]
    p = spark.createDataFrame(pts, "pid int, lon double, lat double")
    cells = ZoneCells(z, "zid")
    got = rows(points_in_zones(p, cells, "zid"), "pid", "zid")
    want = []
    for i, e in zones:
        for k, x, y in pts:
            odd = sum((ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax for ax, ay, bx, by in e) % 2
            if odd:
                want.append((k, i))
    assert got == sorted(want)
    # No point meets a full edge list, and cells are in proportion to edges.
    sizes = cells.cells.select("zid", F.coalesce(F.size("_edges"), F.lit(-1)).alias("n")).collect()
    assert max(r["n"] for r in sizes) < 250
    assert sum(r["zid"] < 3 for r in sizes) < 10 * 20_000
    assert sum(max(r["n"], 0) for r in sizes) < 4 * 20_000
    assert any(r["n"] < 0 for r in sizes)


def test_zones_that_share_an_id_or_have_none_are_zones_of_their_own(spark):
    square = [(0, 0, 4, 0), (4, 0, 4, 4), (4, 4, 0, 4), (0, 4, 0, 0)]
    z = make(spark, [(1, square), (1, square), (None, square)])
    p = spark.createDataFrame([(1, 1.0, 1.0), (2, 9.0, 9.0)], "pid int, lon double, lat double")
    for clip in (True, False):
        got = points_in_zones(p, ZoneCells(z, "zid", clip=clip), "zid").select("pid", "zid").collect()
        assert sorted(((r[0], r[1]) for r in got), key=str) == [(1, 1), (1, 1), (1, None)]


def test_no_zones_no_rows(spark):
    z = make(spark, [(1, [])])
    p = spark.createDataFrame([(1, 1.0, 1.0)], "pid int, lon double, lat double")
    for clip in (True, False):
        cells = ZoneCells(z, "zid", clip=clip)
        assert points_in_zones(p, cells, "zid").collect() == []
        assert count_points_in_zones(p, cells, "zid", max_broadcast_rows=0).collect() == []
    assert clip_zones(z, "zid").collect() == []


def test_counts_go_through_the_join(spark):
    rnd = random.Random(5)
    z = make(spark, [(i, round_zone(400, rnd.uniform(-5, 5), rnd.uniform(-5, 5), 3, 0.1)) for i in range(20)])
    p = spark.range(20_000).select(
        (F.rand(1) * 12 - 6).alias("lon"), (F.rand(2) * 12 - 6).alias("lat")
    )
    p = p.unionByName(spark.range(10_000).select(F.lit(0.25).alias("lon"), F.lit(0.5).alias("lat")))  # a hot place
    cells = ZoneCells(z, "zid")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = count_points_in_zones(p, cells, "zid", max_broadcast_rows=0)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = rows(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == rows(count_points_in_zones(p, cells, "zid"))
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan and "Broadcast" not in plan
    # Joins are by cell; the zone is met by the last sum alone.
    keyed = [line for line in plan.splitlines() if "hashpartitioning(zid" in line]
    assert len(keyed) == 1 and all("_cx" in line for line in plan.splitlines() if "Join [" in line)
