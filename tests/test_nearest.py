import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions import sphere_distance_m
from tessera.operators import nearest_site, nearest_site_summary


def _data(spark, n_pts=2000, n_sites=60, seed=3):
    rnd = random.Random(seed)
    sites = []
    for k in range(n_sites):
        if k < n_sites // 3:  # a dense cluster holding a third of the sites
            lon, lat = -118.3 + rnd.uniform(0, 0.01), 34.0 + rnd.uniform(0, 0.01)
        else:
            lon, lat = rnd.uniform(-119, -117), rnd.uniform(33, 35)
        sites.append((k, f"S{k}", lon, lat))
    sites.append((1000, "dup-late", sites[5][2], sites[5][3]))  # same place as 5, larger key
    sites.append((1001, "nullsite", None, 34.0))
    pts = [(i, rnd.uniform(-120, -116), rnd.uniform(32, 36)) for i in range(n_pts)]
    pts += [(n_pts, None, 34.0), (n_pts + 1, 10.0, 50.0)]  # missing coordinate; far away point
    return (
        spark.createDataFrame(pts, "pid long, lon double, lat double"),
        spark.createDataFrame(sites, "site_key long, site_name string, site_lon double, site_lat double"),
    )


def _brute(pts, sites):
    d = (
        pts.filter(F.col("lon").isNotNull())
        .crossJoin(sites.filter(F.col("site_lon").isNotNull()))
        .withColumn("distance_m", sphere_distance_m("lon", "lat", "site_lon", "site_lat"))
    )
    w = Window.partitionBy("pid").orderBy("distance_m", "site_key")
    return d.withColumn("rn", F.row_number().over(w)).filter("rn = 1")


def _cmp(a, b):
    ra = rows(a, "pid", "site_key", "site_name")
    rb = rows(b, "pid", "site_key", "site_name")
    assert ra == rb
    da = {r["pid"]: r["distance_m"] for r in a.collect()}
    db = {r["pid"]: r["distance_m"] for r in b.collect()}
    assert all(abs(da[k] - db[k]) < 1e-6 for k in db)


@pytest.mark.parametrize("form", ["array", "window"])
def test_broadcast_path_equals_brute_force(spark, form):
    pts, sites = _data(spark)
    got = nearest_site(pts, sites, "pid", site_cols=["site_name"], form=form)
    _cmp(got, _brute(pts, sites))


def test_shuffled_path_equals_brute_force(spark):
    pts, sites = _data(spark, n_pts=800, n_sites=40, seed=11)
    got = nearest_site(pts, sites, "pid", site_cols=["site_name"], max_broadcast_sites=0)
    _cmp(got, _brute(pts, sites))


def test_single_site_and_no_site(spark):
    pts, sites = _data(spark, n_pts=50)
    one = sites.filter("site_key = 3")
    got = nearest_site(pts, one, "pid")
    assert {r["site_key"] for r in got.collect()} == {3} and got.count() == 51
    none = sites.filter("site_key < 0")
    assert nearest_site(pts, none, "pid").count() == 0


def test_array_plan_keeps_points_in_place(spark):
    pts, sites = _data(spark, n_pts=100)
    near = nearest_site(pts, sites, "pid", site_cols=["site_name"])
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # The only exchanges build the broadcast site tables; points never shuffle.
    summary = nearest_site_summary(near, ["site_key", "site_name"])
    assert summary.agg(F.sum("cnt")).collect()[0][0] == 101


def test_whole_globe_poles_and_date_line(spark):
    rnd = random.Random(21)
    sites = [(k, f"S{k}", rnd.uniform(-180, 180), math.degrees(math.asin(rnd.uniform(-1, 1)))) for k in range(300)]
    sites += [(1000, "north", 10.0, 89.9), (1001, "east", 179.95, 0.0), (1002, "west", -179.95, 0.5)]
    pts = [(i, rnd.uniform(-180, 180), math.degrees(math.asin(rnd.uniform(-1, 1)))) for i in range(1500)]
    pts += [(5000, -170.0, 89.95), (5001, -179.99, 0.1), (5002, 179.99, 0.4), (5003, 0.0, -90.0)]
    p = spark.createDataFrame(pts, "pid long, lon double, lat double")
    s = spark.createDataFrame(sites, "site_key long, site_name string, site_lon double, site_lat double")
    got = nearest_site(p, s, "pid", site_cols=["site_name"])
    _cmp(got, _brute(p, s))
    near = {r["pid"]: r["site_key"] for r in got.filter("pid >= 5000").collect()}
    assert near[5000] == 1000 and near[5001] == 1001 and near[5002] == 1002


@pytest.mark.parametrize("bound", [10_000, 0])
def test_exact_ties_go_to_the_smallest_key(spark, bound):
    # Sites placed symmetrically around points: equal distances, so the
    # smaller key must win whatever the float noise of the ranking.
    sites, pts = [], []
    k = 0
    for i in range(30):
        lon, lat = -118.0 + i * 0.01, 34.0 + (i % 5) * 0.01
        for dx, dy in ((0.003, 0.0), (-0.003, 0.0), (0.0, 0.003), (0.0, -0.003)):
            sites.append((1000 - k, f"S{k}", lon + dx, lat + dy))
            k += 1
        pts.append((i, lon, lat))
    s = spark.createDataFrame(sites, "site_key long, site_name string, site_lon double, site_lat double")
    p = spark.createDataFrame(pts, "pid long, lon double, lat double")
    got = nearest_site(p, s, "pid", site_cols=["site_name"], max_broadcast_sites=bound)
    _cmp(got, _brute(p, s))


def test_attach_site_columns(spark):
    from tessera.operators import attach_site_columns

    pts, sites = _data(spark, n_pts=30)
    near = nearest_site(pts, sites, "pid")
    named = attach_site_columns(near, sites, "site_key", ["site_name"])
    assert rows(named, "pid", "site_key", "site_name") == rows(
        nearest_site(pts, sites, "pid", site_cols=["site_name"]), "pid", "site_key", "site_name"
    )


def test_every_plan_gives_one_row_per_point(spark):
    """NULL ids, repeated ids with equal and other places: same rows on all plans."""
    pts = spark.createDataFrame(
        [(None, 0.1, 0.1), (None, 5.0, 5.0), (1, 0.2, 0.2), (1, 80.0, 40.0), (2, 0.1, 0.1), (2, 0.1, 0.1), (3, None, 1.0)],
        "id long, lon double, lat double",
    )
    sites = spark.createDataFrame(
        [(k, 0.1 * k, 0.05 * k) for k in range(40)] + [(99, 80.0, 41.0)], "site_key long, site_lon double, site_lat double"
    )
    plans = [dict(form="array"), dict(form="window"), dict(max_broadcast_sites=0), dict(max_broadcast_sites=0, form="window")]
    key = lambda r: (r["id"] is not None, r["id"] or 0, r["site_key"], round(r["distance_m"], 6))
    got = [sorted(key(r) for r in nearest_site(pts, sites, "id", **p).collect()) for p in plans]
    assert len(got[0]) == 6 and all(g == got[0] for g in got)


def test_far_points_open_few_cubes_of_a_dense_city(spark):
    """A city of 4,000 sites, some sites far apart, points near and very far:
    the pairs looked at stay far below points x sites, and answers are exact."""
    from tessera.operators import nearest as N

    rnd = random.Random(21)
    city = [(i, -118.2 + rnd.gauss(0, 0.02), 34.0 + rnd.gauss(0, 0.02)) for i in range(4000)]
    rest = [(5000 + i, rnd.uniform(-180, 180), rnd.uniform(-80, 80)) for i in range(30)]
    sites = spark.createDataFrame(city + rest, "site_key int, site_lon double, site_lat double")
    pts = [(i, rnd.uniform(-125, -110), rnd.uniform(25, 45)) for i in range(250)]
    pts += [(300 + i, -118.2 + rnd.gauss(0, 0.02), 34.0 + rnd.gauss(0, 0.02)) for i in range(100)]
    points = spark.createDataFrame(pts, "pid int, lon double, lat double")
    got = rows(nearest_site(points, sites, "pid", max_broadcast_sites=0).select("pid", "site_key"))

    def metres(a, b):
        (x1, y1), (x2, y2) = (tuple(map(math.radians, p)) for p in (a, b))
        h = math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2
        return 2 * 6371008.0 * math.asin(min(1.0, math.sqrt(h)))

    want = [(k, min((metres((x, y), (sx, sy)), sk) for sk, sx, sy in city + rest)[1]) for k, x, y in pts]
    assert got == sorted(want)
    s = N._sites(sites, "site_key", "site_lon", "site_lat", []).cache()
    tree = N._cube_tree(s, [])
    opened = N._open_cubes(N._points(points, "pid", "lon", "lat"), tree).join(tree[0], "_cube")
    pairs = opened.agg(F.sum(F.size("_children"))).first()[0]
    assert len(tree) > 1 and pairs < len(pts) * (len(city) + len(rest)) / 10
    plan = nearest_site(points, sites, "pid", max_broadcast_sites=0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_shuffled_plan_on_random_places_and_ties(spark):
    rnd = random.Random(5)
    grid = [(i * 100 + j, i * 1.0, j * 1.0) for i in range(30) for j in range(30)]
    sites = spark.createDataFrame(grid, "site_key int, site_lon double, site_lat double")
    # Half of the points stand in the middle between four sites of one latitude pair.
    pts = [(i, rnd.randrange(29) + 0.5, rnd.randrange(30) * 1.0) for i in range(150)]
    pts += [(200 + i, rnd.uniform(-20, 50), rnd.uniform(-20, 50)) for i in range(150)]
    points = spark.createDataFrame(pts, "pid int, lon double, lat double")
    a = rows(nearest_site(points, sites, "pid", max_broadcast_sites=0))
    b = rows(nearest_site(points, sites, "pid"))
    assert a == b and len(a) == len(pts)


def _nodes(plan):
    """The nodes of an executed plan, those of finished stages included."""
    yield plan
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    if plan.nodeName() == "AdaptiveSparkPlan":
        below.append(plan.executedPlan())
    if "QueryStage" in plan.nodeName():
        below.append(plan.plan())
    for x in below:
        yield from _nodes(x)


def test_window_ranks_only_sites_that_may_win(spark):
    pts, sites = _data(spark, n_pts=500)
    got = nearest_site(pts, sites, "pid", site_cols=["site_name"], form="window")
    n = len(got.collect())
    plan = got._jdf.queryExecution().executedPlan()
    ranked = [x for x in _nodes(plan) if x.nodeName() == "Generate" and "_s#" in x.output().toString()]
    # Without ties a place brings one row to the window, not its whole list.
    assert n == 501 and ranked
    assert all(x.metrics().apply("numOutputRows").value() <= n for x in ranked)


def test_places_of_one_cell_descend_together(spark):
    from tessera.operators import nearest as N

    pts = [(1, 0.5, 0.5, 0.5, 7), (2, 0.5, 0.7, 0.5, 7), (3, 0.1, 0.2, 0.3, 8)]
    places = spark.createDataFrame(pts, "pid int, _px double, _py double, _pz double, _cell int")
    got = sorted(tuple(round(x, 9) for x in r) for r in N._cells(places).collect())
    assert got == [(7, 0.5, 0.6, 0.5, 0.1), (8, 0.1, 0.2, 0.3, 0.0)]
