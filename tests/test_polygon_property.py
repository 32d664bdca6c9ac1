"""polygon_contains against exact rational arithmetic on random polygons.

Vertices are integers and points lie on a 1/8 grid, so many points fall
exactly on edges or vertices; every float operation in the on-edge test is
then exact, and the expected answer is computed with Fractions.
"""

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import polygon_contains
from tessera.functions.geo import EDGE_TYPE


def _star(rnd, cx, cy, k, rmin, rmax):
    pts = []
    for j in range(k):
        a = 2 * math.pi * (j + rnd.random() * 0.5) / k
        r = rnd.uniform(rmin, rmax)
        pts.append((round(cx + r * math.cos(a)), round(cy + r * math.sin(a))))
    # drop repeated consecutive vertices from rounding
    out = [p for i, p in enumerate(pts) if p != pts[i - 1]]
    return out if len(set(out)) >= 3 else None


def _edges(rings):
    return [(a[0], a[1], b[0], b[1]) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1])]


def _truth(edges, px, py):
    x, y = Fraction(px), Fraction(py)
    inside = False
    for ax, ay, bx, by in edges:
        ax, ay, bx, by = map(Fraction, (ax, ay, bx, by))
        cross = (x - ax) * (by - ay) - (y - ay) * (bx - ax)
        if cross == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return False  # on the boundary: not contained
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
    return inside


def test_contains_matches_exact_arithmetic(spark):
    rnd = random.Random(11)
    cases = []
    for case in range(300):
        outer = _star(rnd, 0, 0, rnd.randint(3, 9), 3, 10)
        if outer is None:
            continue
        rings = [outer]
        kind = case % 3
        if kind == 1:  # a hole well inside the outer ring's inner radius
            hole = _star(rnd, 0, 0, rnd.randint(3, 6), 1, 2)
            if hole:
                rings.append(hole)
        elif kind == 2:  # a second, separate part
            part = _star(rnd, 25, 0, rnd.randint(3, 7), 2, 6)
            if part:
                rings.append(part)
        edges = _edges(rings)
        for _ in range(40):
            if rnd.random() < 0.3:  # a point on an edge or vertex
                ax, ay, bx, by = rnd.choice(edges)
                t = Fraction(rnd.randint(0, 8), 8)
                px, py = ax + t * (bx - ax), ay + t * (by - ay)
                if px.denominator > 8 or py.denominator > 8:
                    continue
            else:
                px, py = Fraction(rnd.randint(-96, 280), 8), Fraction(rnd.randint(-96, 96), 8)
            cases.append((len(cases), [tuple(map(float, e)) for e in edges], float(px), float(py), _truth(edges, px, py)))
    schema = T.StructType(
        [
            T.StructField("i", T.IntegerType()),
            T.StructField("edges", T.ArrayType(EDGE_TYPE)),
            T.StructField("x", T.DoubleType()),
            T.StructField("y", T.DoubleType()),
            T.StructField("want", T.BooleanType()),
        ]
    )
    df = spark.createDataFrame(cases, schema)
    bad = df.filter(polygon_contains("edges", "x", "y") != F.col("want")).count()
    assert bad == 0
    assert sum(c[4] for c in cases) > 500 and len(cases) > 8000
