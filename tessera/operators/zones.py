"""Zones (polygons) from GeoJSON and the points they contain.

Point-in-polygon join at scale, with no nested-loop join and no full edge list
joined to a point:

1. Each zone gets a level of one global dyadic grid (square cells of ``2**l``
   degrees): the finest at which its box spans at most about twice the square
   root of its edges per axis, so a zone's cells are in proportion to its edges
   whatever its size, and nothing is capped.
2. The zone's boundary is clipped to these cells (:func:`clip_zones`).  A cell
   that no edge touches is wholly inside or wholly outside; the inside ones are
   kept without any edges.  A border cell keeps the edges that touch it and,
   for all edges to its right, the parity that they add to a ray: a base and
   the heights at which it flips.  These stand as far upright edges, so the cell's
   list is a small polygon that gives the zone's own verdict on every point of
   the cell, bit by bit.
3. Each point computes its one cell per level in use (few levels) and meets the
   zones of that cell by an equi-join; only points in border cells are tested.

Counting needs no point at all in inside cells: points are counted per cell
first and whole cells' counts are added to the zones that hold them.

Zones of a few edges each need no clipping: their cells carry all their edges.
The cell table is broadcast when its exact size (rows and edges) is within
bounds, otherwise shuffled on the cell (AQE splits hot ones).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.geo import EDGE_TYPE, edges_bbox, geojson_edges, polygon_contains
from tessera.session import checkpoint_dir, spread


def zones_from_geojson(
    features: DataFrame,
    geom_type_col: str = "geom_type",
    coordinates_col: str = "coordinates",
    edges_col: str = "edges",
) -> DataFrame:
    """Add ``edges`` (array of ``struct<ax,ay,bx,by>``) parsed from a GeoJSON
    Polygon/MultiPolygon; other types or unparseable geometry give NULL
    edges.  A zone with NULL or no edges contains no point.

    No filter is put on ``edges`` here: Catalyst pushes filters below the
    projection and would inline the whole parse into the condition."""
    return features.withColumn(edges_col, geojson_edges(F.col(geom_type_col), F.col(coordinates_col)))


def with_bbox(zones: DataFrame, edges_col: str = "edges") -> DataFrame:
    minx, miny, maxx, maxy = edges_bbox(edges_col)
    return zones.withColumns({"min_x": minx, "min_y": miny, "max_x": maxx, "max_y": maxy})


# Cell edge between 2**-30 degrees (~0.1 mm) and 2**8 degrees (whole globe).
_MIN_LEVEL, _MAX_LEVEL = -30, 8
# Beyond every coordinate: where the upright edges stand.
_FAR = 1.0e6
# Zones of at most so many edges are not clipped.
SHORT = 16


def _zone_levels(zones: DataFrame, zone_id: str, edges_col: str) -> DataFrame:
    """Zones with a row key, level, cell size and the range of their cells."""
    z = with_bbox(zones.select(F.col(zone_id).alias("_zone"), F.col(edges_col).alias("_edges")), "_edges")
    extent = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"))
    per_axis = F.greatest(F.lit(4.0), F.ceil(2 * F.sqrt(F.size("_edges").cast("double"))).cast("double"))
    level = F.coalesce(F.ceil(F.log2(extent / per_axis)), F.lit(_MIN_LEVEL))
    level = F.least(F.lit(_MAX_LEVEL), F.greatest(F.lit(_MIN_LEVEL), level))
    # A zone without edges has no box, hence no cells.
    z = z.filter(extent.isNotNull()).withColumn("_lvl", level.cast("int"))
    z = z.withColumn("_s", F.pow(F.lit(2.0), F.col("_lvl")))
    cell = lambda c: F.floor(F.col(c) / F.col("_s"))
    z = z.select(
        F.monotonically_increasing_id().alias("_row"), "_zone", "_edges", "_lvl", "_s",
        cell("min_x").alias("_x0"), cell("max_x").alias("_x1"), cell("min_y").alias("_y0"), cell("max_y").alias("_y1"),
    )
    return z


# One row of a zone's cells; the zone's id and level go with its row key.
_BAND = ["_row", "_zone", "_lvl", "_cy"]


def _edge_bands(z: DataFrame) -> DataFrame:
    """Every edge once per row of cells that it reaches, with the columns
    ``_a`` to ``_b`` that its part in that row touches (a hair more, so that
    rounding never puts an edge beside a cell that it touches)."""
    e = z.select("_row", "_zone", "_lvl", "_s", "_x0", "_x1", "_y0", "_y1", F.explode("_edges").alias("e"))
    e = e.withColumns(
        {
            "_pad": F.col("_s") * 1e-6 + 1e-12,
            "_lo": F.least("e.ay", "e.by"),
            "_hi": F.greatest("e.ay", "e.by"),
        }
    )
    first = F.greatest(F.floor((F.col("_lo") - F.col("_pad")) / F.col("_s")), F.col("_y0"))
    last = F.least(F.floor((F.col("_hi") + F.col("_pad")) / F.col("_s")), F.col("_y1"))
    e = e.withColumn("_cy", F.explode(F.sequence(first, last)))

    def x_at(y: Column) -> Column:
        y = F.least(F.col("_hi"), F.greatest(F.col("_lo"), y))
        run = (F.col("e.bx") - F.col("e.ax")) * (y - F.col("e.ay"))
        return F.col("e.ax") + F.try_divide(run, F.col("e.by") - F.col("e.ay"))

    base = F.col("_cy") * F.col("_s")
    e = e.withColumns({"_p": x_at(base - F.col("_pad")), "_q": x_at(base + F.col("_s") + F.col("_pad"))})
    flat = F.col("_lo") == F.col("_hi")
    left = F.when(flat, F.least("e.ax", "e.bx")).otherwise(F.least("_p", "_q"))
    right = F.when(flat, F.greatest("e.ax", "e.bx")).otherwise(F.greatest("_p", "_q"))
    return e.select(
        *_BAND, "e", "_s", "_x0", "_x1",
        F.floor((left - F.col("_pad")) / F.col("_s")).alias("_a"),
        F.floor((right + F.col("_pad")) / F.col("_s")).alias("_b"),
    )


def clip_zones(zones: DataFrame, zone_id: str, edges_col: str = "edges") -> DataFrame:
    """The zones' cells: ``_lvl, _cx, _cy``, the zone id and ``_edges``.

    ``_edges`` is NULL in a cell wholly inside the zone; else the even-odd rule
    over it gives the zone's verdict on every point of the cell.  Work and
    rows are in proportion to the zones' edges; every step is a join-free pass,
    a grouping by zone and cell, or a window over a zone's one row of cells.
    """
    checkpoint_dir(zones.sparkSession)
    # The row keys must be the same in both uses of the bands.
    bands = _edge_bands(_zone_levels(zones, zone_id, edges_col).checkpoint())
    base = F.col("_cy") * F.col("_s")
    straddles = (F.col("e.ay") > base) != (F.col("e.by") > base)
    upright = lambda y: F.struct(
        F.lit(_FAR).alias("ax"), y.alias("ay"), F.lit(_FAR).alias("bx"), F.lit(_FAR).alias("by")
    )
    # Edges in the cells that they touch; the leftmost counts those that
    # straddle the row's lower side, for all cells to its left.
    touch = bands.select(
        *_BAND, F.explode(F.sequence(F.greatest("_a", "_x0"), F.least("_b", "_x1"))).alias("_cx"), "e",
        "_a", straddles.alias("_straddles"),
    ).select(*_BAND, "_cx", "e", ((F.col("_a") == F.col("_cx")) & F.col("_straddles")).cast("int").alias("_n"))

    # A corner inside a row flips the parity of the cells for which one of its
    # two edges is to the right and the other is not.
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    corners = bands.select(
        *_BAND, "_x0", "_x1", "_a", base.alias("_low"), (base + F.col("_s")).alias("_high"),
        F.explode(F.array(corner("e.ax", "e.ay"), corner("e.bx", "e.by"))).alias("v"),
    ).filter((F.col("v.y") > F.col("_low")) & (F.col("v.y") < F.col("_high")))
    ranges = (
        corners.groupBy(*_BAND, "_x0", "_x1", F.col("v.x").alias("_vx"), F.col("v.y").alias("_vy"))
        .agg(F.sort_array(F.collect_list("_a"), asc=False).alias("_as"))
        .select(*_BAND, "_x0", "_x1", "_vy", F.posexplode("_as").alias("_i", "_top"), "_as")
        .filter(F.col("_i") % 2 == 0)
        .withColumn("_from", F.greatest(F.col("_x0"), F.coalesce(F.get("_as", F.col("_i") + 1), F.col("_x0"))))
        .withColumn("_to", F.least(F.col("_x1"), F.col("_top") - 1))
        .filter("_from <= _to")
    )
    flips = ranges.select(
        *_BAND, F.explode(F.sequence("_from", "_to")).alias("_cx"), upright(F.col("_vy")).alias("e"), F.lit(0).alias("_n")
    )
    # Dealt once, by the zone's row of cells: the grouping and the window keep it.
    cells = (
        touch.unionByName(flips)
        .repartition("_row", "_cy")
        .groupBy(*_BAND, "_cx")
        .agg(F.collect_list("e").alias("_edges"), F.sum("_n").alias("_n"))
    )
    right = Window.partitionBy("_row", "_cy").orderBy(F.col("_cx").desc())
    cells = cells.withColumns(
        {
            "_odd": F.coalesce(F.sum("_n").over(right.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 1,
            "_next": F.lag("_cx").over(right),
        }
    )
    whole = F.array(F.struct(*[F.lit(v).alias(c) for c, v in (("ax", _FAR), ("ay", -_FAR), ("bx", _FAR), ("by", _FAR))]))
    border = F.struct(
        F.col("_cx").alias("cx"),
        F.when(F.col("_odd"), F.concat("_edges", whole)).otherwise(F.col("_edges")).alias("edges"),
    )
    # The cells up to the next border cell are inside if this one's base is odd.
    gap = F.when(
        F.col("_odd") & (F.col("_next") > F.col("_cx") + 1),
        F.transform(
            F.sequence(F.col("_cx") + 1, F.col("_next") - 1),
            lambda c: F.struct(c.alias("cx"), F.lit(None).cast(f"array<{EDGE_TYPE.simpleString()}>").alias("edges")),
        ),
    )
    every = F.explode(F.concat(F.array(border), F.coalesce(gap, F.array().cast(_CELLS)))).alias("c")
    return cells.select("_lvl", "_cy", "_zone", every).select(
        "_lvl", F.col("c.cx").alias("_cx"), "_cy", F.col("_zone").alias(zone_id), F.col("c.edges").alias("_edges")
    )


_CELLS = f"array<struct<cx:bigint,edges:array<{EDGE_TYPE.simpleString()}>>>"


class ZoneCells:
    """The zones' cells (:func:`clip_zones`) with what decides the plan.

    Zones are clipped, and the cells materialised, if one has more than
    ``SHORT`` edges (or as ``clip`` says); else every cell of a zone's box
    carries the zone's few edges and nothing is moved.
    """

    def __init__(self, zones: DataFrame, zone_id: str, edges_col: str = "edges", clip: bool | None = None):
        self.zone_id = zone_id
        z = _zone_levels(zones, zone_id, edges_col)
        n = (F.col("_x1") - F.col("_x0") + 1) * (F.col("_y1") - F.col("_y0") + 1)
        sums = lambda rows, edges: [
            F.collect_set("_lvl").alias("levels"),
            F.coalesce(F.sum(rows), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(edges), F.lit(0)).alias("edges"),
            F.coalesce(F.max(F.size("_edges")), F.lit(0)).alias("longest"),
        ]
        info = z.agg(*sums(n, n * F.size("_edges"))).first()
        if clip or (clip is None and info["longest"] > SHORT):
            self.cells = clip_zones(zones, zone_id, edges_col).checkpoint()
            info = self.cells.agg(*sums(F.lit(1), F.greatest(F.size("_edges"), F.lit(0)))).first()
        else:
            rows = z.select("_lvl", "_zone", "_edges", "_y0", "_y1", F.explode(F.sequence("_x0", "_x1")).alias("_cx"))
            self.cells = rows.select(
                "_lvl", "_cx", F.explode(F.sequence("_y0", "_y1")).alias("_cy"), F.col("_zone").alias(zone_id), "_edges"
            )
        self.levels, self.rows, self.edges = sorted(info["levels"]), info["rows"], info["edges"]

    def small(self, max_rows: int, max_edges: int) -> bool:
        return self.rows <= max_rows and self.edges <= max_edges

    def probes(self, points: DataFrame, lon: str, lat: str) -> DataFrame:
        """Every point once per level in use, with its cell there."""
        keys = [
            F.struct(
                F.lit(l).alias("_lvl"),
                F.floor(F.col(lon) / F.lit(2.0**l)).alias("_cx"),
                F.floor(F.col(lat) / F.lit(2.0**l)).alias("_cy"),
            )
            for l in self.levels
        ]
        key = F.explode(F.array(*keys)) if len(keys) > 1 else keys[0]
        return points.withColumn("_key", key).select("*", "_key._lvl", "_key._cx", "_key._cy").drop("_key")


def _located(points: DataFrame, lon: str, lat: str) -> DataFrame:
    return spread(points.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()))


def points_in_zones(
    points: DataFrame,
    zones: DataFrame | ZoneCells,
    zone_id: str,
    lon: str = "lon",
    lat: str = "lat",
    edges_col: str = "edges",
    max_broadcast_rows: int = 1_000_000,
    max_broadcast_edges: int = 4_000_000,
) -> DataFrame:
    """Every (point row, zone id) pair where the zone strictly contains the point.

    All point columns are kept.  A point in overlapping zones appears once
    per zone; a point in no zone does not appear (inner semantics).  Points
    with a NULL coordinate are ignored.  Every row of ``zones`` is a zone of
    its own, whatever its id.
    """
    z = zones if isinstance(zones, ZoneCells) else ZoneCells(zones, zone_id, edges_col)
    if not z.levels:
        return points.limit(0).withColumn(zone_id, F.lit(None).cast(z.cells.schema[zone_id].dataType))
    p = _located(points, lon, lat)
    cells = F.broadcast(z.cells) if z.small(max_broadcast_rows, max_broadcast_edges) else z.cells
    cand = z.probes(p, lon, lat).join(cells, ["_lvl", "_cx", "_cy"])
    hits = cand.filter(F.col("_edges").isNull() | polygon_contains("_edges", lon, lat))
    return hits.select(*p.columns, zone_id)


def count_points_in_zones(
    points: DataFrame,
    zones: DataFrame | ZoneCells,
    zone_id: str,
    lon: str = "lon",
    lat: str = "lat",
    count_col: str = "cnt",
    edges_col: str = "edges",
    max_broadcast_rows: int = 1_000_000,
    max_broadcast_edges: int = 4_000_000,
) -> DataFrame:
    """Points per zone (zones with no point are absent); only the
    coordinates of the points are read.

    Where the cells can be broadcast, points never move and only partial counts
    do.  Otherwise the count goes through the join: points are counted per cell
    (partially before the shuffle, so a hot cell is one number a task), the
    cells inside a zone add their counts whole, and only points in border
    cells meet edges, joined by cell.  Zones meet in the last sum alone.
    """
    z = zones if isinstance(zones, ZoneCells) else ZoneCells(zones, zone_id, edges_col)
    p = points.select(lon, lat)
    if not z.levels or z.small(max_broadcast_rows, max_broadcast_edges):
        hits = points_in_zones(p, z, zone_id, lon, lat, edges_col, max_broadcast_rows, max_broadcast_edges)
        return hits.groupBy(zone_id).agg(F.count(F.lit(1)).alias(count_col))
    key = ["_lvl", "_cx", "_cy"]
    probes = z.probes(_located(p, lon, lat), lon, lat)
    per_cell = probes.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    inside = z.cells.filter(F.col("_edges").isNull()).select(*key, zone_id).join(per_cell, key).select(zone_id, "_n")
    border = z.cells.filter(F.col("_edges").isNotNull())
    tested = probes.join(border, key).filter(polygon_contains("_edges", lon, lat)).select(zone_id, F.lit(1).cast("long").alias("_n"))
    return inside.unionByName(tested).groupBy(zone_id).agg(F.sum("_n").alias(count_col))


__all__ = ["ZoneCells", "zones_from_geojson", "with_bbox", "clip_zones", "points_in_zones", "count_points_in_zones"]
