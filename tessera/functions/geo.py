"""Geometry as ordinary columns: points are (lon, lat) doubles in WGS84
degrees, polygons are arrays of directed edges ``struct<ax, ay, bx, by>``.

Nothing here needs a geometry extension; every function returns a Column
that Catalyst can push, prune and (outside lambdas) code-generate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: mean Earth radius in metres used by the spherical distance.
EARTH_RADIUS_M = 6371008.0

EDGE_TYPE = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("ax", "ay", "bx", "by")]
)
POLYGON_COORDS = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
MULTIPOLYGON_COORDS = T.ArrayType(POLYGON_COORDS)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sphere_distance_m(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle (haversine) distance in metres between two lon/lat points."""
    lon1, lat1, lon2, lat2 = map(_col, (lon1, lat1, lon2, lat2))
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * F.lit(EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def sphere_distance_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Spark SQL text of :func:`sphere_distance_m`, same operations in the
    same order (so the same bits)."""
    return (
        f"2 * {EARTH_RADIUS_M!r}D * asin(sqrt(least(1.0D, pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def unit_vector(lon, lat) -> tuple[Column, Column, Column]:
    """(x, y, z) of the point on the unit sphere."""
    lon, lat = _col(lon), _col(lat)
    rlon, rlat = F.radians(lon), F.radians(lat)
    return F.cos(rlat) * F.cos(rlon), F.cos(rlat) * F.sin(rlon), F.sin(rlat)


def chord(x1, y1, z1, x2, y2, z2) -> Column:
    """Straight-line distance between two unit vectors (monotone in arc length)."""
    return F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2) + F.pow(z1 - z2, 2))


# Cube cells on the unit sphere: three signed cell indices packed in one long.
_CELL_OFFSET = 1 << 20
MIN_CELL = 2.0 / (1 << 19)  # smallest cell edge the 21-bit packing allows


def _pack_sql(ix: str, iy: str, iz: str) -> str:
    o = _CELL_OFFSET
    return f"(({ix}) + {o}) * {1 << 42} + (({iy}) + {o}) * {1 << 21} + (({iz}) + {o})"


def cell_key_sql(x: str, y: str, z: str, h: float) -> str:
    """SQL text of :func:`cell_key`, for building larger expressions."""
    return _pack_sql(*[f"CAST(floor(`{c}` / {h!r}) AS BIGINT)" for c in (x, y, z)])


def cell_key(x: str, y: str, z: str, h: float) -> Column:
    """Packed id of the cube cell (edge ``h``) holding the unit vector in
    columns x, y, z (built as one SQL expression: one call to the JVM)."""
    return F.expr(cell_key_sql(x, y, z, h))


def neighbour_cell_keys(x: str, y: str, z: str, h: float) -> Column:
    """Array of the 27 packed ids of the 3x3x3 block of cubes around the cube
    holding (x, y, z)."""
    ix, iy, iz = [f"CAST(floor(`{c}` / {h!r}) AS BIGINT)" for c in (x, y, z)]
    body = _pack_sql(f"{ix} + (i div 9) - 1", f"{iy} + ((i div 3) % 3) - 1", f"{iz} + (i % 3) - 1")
    return F.expr(f"transform(sequence(0, 26), i -> {body})")


def ring_edges(ring: Column) -> Column:
    """Directed edges of one ring (array of [x, y]); a closed ring's repeated
    last point is not turned into a zero-length edge."""
    n = F.size(ring)
    closed = (n > 1) & (ring[0] == ring[n - 1])
    m = n - F.when(closed, 1).otherwise(0)
    return F.when(
        m >= 2,
        F.transform(
            F.sequence(F.lit(0), m - 1),
            lambda i: F.struct(
                ring[i][0].alias("ax"),
                ring[i][1].alias("ay"),
                ring[(i + 1) % m][0].alias("bx"),
                ring[(i + 1) % m][1].alias("by"),
            ),
        ),
    ).otherwise(F.array().cast(T.ArrayType(EDGE_TYPE)))


def geojson_edges(geom_type: Column | str, coordinates_json: Column | str) -> Column:
    """Edges of a GeoJSON Polygon or MultiPolygon given its raw ``coordinates``
    JSON text.  All rings of all parts go into one array; the even-odd rule
    then treats holes and parts correctly.  Other types give NULL."""
    t, c = _col(geom_type), _col(coordinates_json)
    poly_rings = F.from_json(c, POLYGON_COORDS)
    multi_rings = F.flatten(F.from_json(c, MULTIPOLYGON_COORDS))
    rings = F.when(t == "Polygon", poly_rings).when(t == "MultiPolygon", multi_rings)
    return F.flatten(F.transform(rings, ring_edges))


def edges_bbox(edges: Column | str) -> tuple[Column, Column, Column, Column]:
    """(min_x, min_y, max_x, max_y) over all edge end points."""
    e = _col(edges)
    return (
        F.array_min(F.transform(e, lambda s: s["ax"])),
        F.array_min(F.transform(e, lambda s: s["ay"])),
        F.array_max(F.transform(e, lambda s: s["ax"])),
        F.array_max(F.transform(e, lambda s: s["ay"])),
    )


def polygon_contains(edges: Column | str, px: Column | str, py: Column | str) -> Column:
    """True when the point lies strictly inside the polygon (even-odd rule).

    Points on an edge or vertex are not contained, as for a DE-9IM
    "contains".  The crossing test divides only when the edge straddles the
    point's latitude, so no zero division can happen under ANSI mode.
    """
    e, x, y = _col(edges), _col(px), _col(py)

    def step(acc, s):
        straddles = (s["ay"] > y) != (s["by"] > y)
        x_at = (s["bx"] - s["ax"]) * (y - s["ay"]) / (s["by"] - s["ay"]) + s["ax"]
        on_edge = (
            (x >= F.least(s["ax"], s["bx"]))
            & (x <= F.greatest(s["ax"], s["bx"]))
            & (y >= F.least(s["ay"], s["by"]))
            & (y <= F.greatest(s["ay"], s["by"]))
            & ((x - s["ax"]) * (s["by"] - s["ay"]) == (y - s["ay"]) * (s["bx"] - s["ax"]))
        )
        crossed = F.when(straddles, F.when(x < x_at, 1).otherwise(0)).otherwise(0)
        return acc + crossed + F.when(on_edge, F.lit(_ON_EDGE)).otherwise(0)

    # One walk: crossings below _ON_EDGE, edges that hold the point from there on.
    seen = F.aggregate(e, F.lit(0).cast("long"), step)
    return (seen < _ON_EDGE) & ((seen % 2) == 1)


_ON_EDGE = 1 << 40
