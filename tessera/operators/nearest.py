"""Nearest site to every point by great-circle distance, exactly, without
forming all point x site pairs.

Search structure: points and sites become unit vectors; space is cut into
cubes of edge ``h``.  Every site is listed in the 27 cubes around its own,
so the candidates of a point's cube are all sites whose cube is at most one
step away on each axis.  A site outside that list differs from the point by
more than ``h`` on some axis, so its straight-line (chord) distance exceeds
``h``.  Hence when the best listed candidate lies within ``h`` of the point,
it is the true nearest site (ties included).  Points not resolved this way
try coarser cubes (8x per level) and finally all sites.

Two physical plans:

* sites within ``max_broadcast_sites`` (the count is checked): the per-cube
  candidate lists are broadcast and every point is resolved inside its own
  partition -- a chain of broadcast hash joins plus ``array_min`` over the
  candidates; no shuffle of points at all.  A point already resolved joins
  with a NULL key, so it carries no further candidate lists.  The last
  resort, the list of all sites, is a scalar subquery evaluated once.
* more sites: best-first branch and bound over a tree of cubes.  A cube is
  summed up by the tight box of its sites and its most central site; its
  children (or, in the finest cubes, its sites) are one array.  A point keeps the
  cubes whose box may hold its nearest site: those no farther, at their nearest,
  than the central site of any other.  Places of one small cell descend together: from
  the middle of their box, with twice its radius added to the bound, cubes are
  opened level by level with shuffled equi-joins on the cube id (AQE splits hot
  cubes).  A place then chooses among its cell's finest cubes by itself, so a
  point far outside a dense city opens the few cubes on the city's near side,
  not the city.

Ties in distance go to the smallest site key; sites sharing one location are
first reduced to the smallest key, which can never lose such a tie.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.functions.geo import (
    MIN_CELL,
    cell_key,
    cell_key_sql,
    neighbour_cell_keys,
    sphere_distance_m,
    sphere_distance_sql,
    unit_vector,
)
from tessera.session import bounded_broadcast, checkpoint_dir, spread

_EPS = 1e-9  # chord slack on the unit sphere (~6 mm on Earth)
_TIE = 1e-9  # relative squared-chord band re-ranked by exact distance


def _points(points: DataFrame, point_id: str, lon: str, lat: str) -> DataFrame:
    p = points.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(
        F.col(point_id), F.col(lon).alias("_plon"), F.col(lat).alias("_plat")
    )
    x, y, z = unit_vector("_plon", "_plat")
    return spread(p).withColumns({"_px": x, "_py": y, "_pz": z})


def _sites(sites: DataFrame, site_key: str, lon: str, lat: str, payload: list[str]) -> DataFrame:
    """Sites reduced to one per location (smallest key, with its attributes)."""
    s = (
        sites.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull() & F.col(site_key).isNotNull())
        .groupBy(F.col(lon).alias("_slon"), F.col(lat).alias("_slat"))
        .agg(F.min(F.struct(F.col(site_key).alias("_sk"), *[F.col(c) for c in payload])).alias("_kp"))
        .select("_slon", "_slat", "_kp.*")
    )
    x, y, z = unit_vector("_slon", "_slat")
    return s.withColumns({"_sx": x, "_sy": y, "_sz": z})


_SITE_FIELDS = ("_sk", "_slon", "_slat", "_sx", "_sy", "_sz")


def _entry(payload: list[str]) -> Column:
    """What a candidate list holds per site: key, lon/lat, unit vector, attributes."""
    return F.struct(*_SITE_FIELDS, *payload)


def _exact(lon: Column, lat: Column, k: Column, extra: list[Column]) -> Column:
    """(great-circle distance, key, lon, lat, attributes...): the final order."""
    return F.struct(
        sphere_distance_m("_plon", "_plat", lon, lat).alias("d"),
        k.alias("k"),
        lon.alias("lon"),
        lat.alias("lat"),
        *extra,
    )


def _exact_of_entry(e: Column, payload: list[str]) -> Column:
    return _exact(e["_slon"], e["_slat"], e["_sk"], [e[x].alias(x) for x in payload])


def _c2_sql(e: str) -> str:
    return (
        f"((_px - {e}._sx) * (_px - {e}._sx) + (_py - {e}._sy) * (_py - {e}._sy)"
        f" + (_pz - {e}._sz) * (_pz - {e}._sz))"
    )


def _fields_sql(e: str, payload: list[str]) -> str:
    extra = "".join(f", '{c}', {e}.`{c}`" for c in payload)
    return f"'k', {e}._sk, 'lon', {e}._slon, 'lat', {e}._slat{extra}"


def _pick_sql(arr: str, best: str, payload: list[str]) -> tuple[Column, Column]:
    """(chord-best candidate, exact best) over the site entries in array
    column ``arr``; the second expression reads the first from column ``best``.

    The squared chord between unit vectors orders sites as the great-circle
    distance does, with a few multiply-adds and no trigonometry.  The entries
    within 1e-9 (relative) of the chord-best are then compared by great-circle
    distance and key, so the answer is exactly "smallest distance, then
    smallest key".  Built as SQL text: one call to the JVM per expression."""
    chord_best = f"array_min(transform(`{arr}`, e -> named_struct('c2', {_c2_sql('e')}, {_fields_sql('e', payload)})))"
    dist = sphere_distance_sql("_plon", "_plat", "e._slon", "e._slat")
    exact = (
        f"array_min(transform(filter(`{arr}`, e -> {_c2_sql('e')} <= `{best}`.c2 * {1.0 + _TIE!r}D),"
        f" e -> named_struct('d', {dist}, {_fields_sql('e', payload)})))"
    )
    return F.expr(chord_best), F.expr(exact)


def _closest(arr: str, best: str) -> Column:
    """The entries of array column ``arr`` that may be the exact best: those
    within the tie band of the chord-best in column ``best``."""
    return F.expr(f"filter(`{arr}`, e -> {_c2_sql('e')} <= `{best}`.c2 * {1.0 + _TIE!r}D)")


def _within(best: Column, h: float) -> Column:
    return best["c2"] <= F.lit((h - _EPS) ** 2)


def _neighbour_rows(s: DataFrame, h: float, payload: list[str]) -> DataFrame:
    """Each site once per cube in the 3x3x3 block around its own cube."""
    keys = neighbour_cell_keys("_sx", "_sy", "_sz", h)
    return s.select(F.explode(keys).alias("_cell"), *_SITE_FIELDS, *payload)


def _levels(h0: float, levels: int) -> list[float]:
    """Cube edges h0, 8*h0, 64*h0, ... (at most ``levels``), capped at 2 (the
    unit sphere's diameter, where one level holds every site)."""
    out = []
    for r in range(levels):
        h = h0 * 8**r
        out.append(min(h, 2.0))
        if h >= 2.0:
            break
    return out


# Cube edges: 2**-1 ... 2**-19 (MIN_CELL) on the unit sphere.
_SCALES = [2.0**-j for j in range(1, 20)]
# Edges of a cube and of its children differ by this factor; the search starts
# from at most so many cubes (or the few on the whole globe at the largest edge)
# and ends in cubes of at most so many sites, where the smallest edge allows it.
_FACTOR, _TOP, _LEAF = 4, 32, 8


def _typical_edge(n: int, extent: float) -> float:
    """About one site spacing over the sites' extent."""
    return min(max(extent / math.sqrt(n), MIN_CELL), 2.0)


def _finest(h_ext: float, densest: dict[int, int], max_sites_per_cell: int) -> float:
    """The largest cube edge not above ``h_ext`` whose densest cube holds at most
    ``max_sites_per_cell`` sites, so a city holding a third of all sites gets
    small cubes instead of one huge candidate list."""
    scales = [(j, h) for j, h in enumerate(_SCALES) if h <= h_ext] or [(len(_SCALES) - 1, _SCALES[-1])]
    fits = [h for j, h in scales if densest.get(j, 0) <= max_sites_per_cell]
    return fits[0] if fits else scales[-1][1]


def _plan_small(xyz: np.ndarray, max_sites_per_cell: int) -> tuple[float, float | None]:
    """(typical edge, finest edge) for few sites, from their unit vectors;
    the finest is None when all sites share one place."""
    extent = float((xyz.max(axis=0) - xyz.min(axis=0)).max())
    if len(xyz) <= 1 or extent <= 0:
        return 0.0, None
    h_ext = _typical_edge(len(xyz), extent)
    densest = {
        j: int(np.unique(np.floor(xyz / h), axis=0, return_counts=True)[1].max())
        for j, h in enumerate(_SCALES)
        if h <= h_ext
    }
    return h_ext, _finest(h_ext, densest, max_sites_per_cell)


def _census(s: DataFrame) -> dict[int, tuple[int, int]]:
    """For each cube edge: the sites of the densest cube and the number of
    cubes, by one distributed aggregate."""
    pairs = ", ".join(f"named_struct('j', {j}, 'c', {cell_key_sql('_sx', '_sy', '_sz', h)})" for j, h in enumerate(_SCALES))
    keyed = s.select(F.expr(f"explode(array({pairs}))").alias("k"))
    per_cube = keyed.groupBy("k.j", "k.c").count()
    rows = per_cube.groupBy("j").agg(F.max("count").alias("m"), F.count(F.lit(1)).alias("n")).collect()
    return {r["j"]: (r["m"], r["n"]) for r in rows}


def nearest_site(
    points: DataFrame,
    sites: DataFrame,
    point_id: str,
    lon: str = "lon",
    lat: str = "lat",
    site_key: str = "site_key",
    site_lon: str = "site_lon",
    site_lat: str = "site_lat",
    site_cols: list[str] | None = None,
    form: str = "array",
    levels: int = 3,
    max_levels: int = 8,
    max_broadcast_sites: int = 10_000,
    max_broadcast_entries: int = 2_000_000,
    max_sites_per_cell: int = 32,
    distance_col: str = "distance_m",
) -> DataFrame:
    """(point_id, site_key, distance_m, *site_cols) of the nearest site for every point.

    ``site_cols`` are site attributes carried along with each candidate, so
    no join back to the site table is needed.

    The broadcast plan is used when the site count is within
    ``max_broadcast_sites`` and its candidate lists (27 entries per site per
    level) within ``max_broadcast_entries``; otherwise the shuffled plan.
    Points or sites with a NULL coordinate are ignored; with no sites the
    result is empty (as a cross join with an empty side would be).
    ``form="array"`` picks the best candidate with ``array_min`` in the
    point's own row; ``form="window"`` explodes the candidates that may win
    (those within the tie band of the chord-best) and keeps ``row_number() == 1``
    per place (the classic plan).  Every form and plan
    gives one row for each input row, whatever its id.
    """
    if form not in ("array", "window"):
        raise ValueError("form must be 'array' or 'window'")
    payload = list(site_cols or [])
    pts = _points(points, point_id, lon, lat)
    s = _sites(sites, site_key, site_lon, site_lat, payload)
    key_type = sites.schema[site_key].dataType
    # One job: the sites themselves if they are few, else only that they are not.
    few = s.limit(max_broadcast_sites + 1).toArrow()
    n, hs = few.num_rows, []
    if n == 0:
        return pts.select(
            point_id,
            F.lit(None).cast(key_type).alias(site_key),
            F.lit(None).cast("double").alias(distance_col),
            *[F.lit(None).cast(sites.schema[c].dataType).alias(c) for c in payload],
        ).limit(0)
    if n <= max_broadcast_sites:
        xyz = np.column_stack([few.column(c).to_numpy() for c in ("_sx", "_sy", "_sz")])
        h_ext, h0 = _plan_small(xyz, max_sites_per_cell)
        if h0 is not None:
            # Enough 8x levels to reach 32x the typical edge from the finest one.
            span = 1 + max(0, math.ceil(math.log(32 * h_ext / h0, 8)))
            hs = _levels(h0, min(max(levels, span), max_levels))
        s = pts.sparkSession.createDataFrame(few, s.schema).coalesce(1)
    # The broadcast lists hold 27 entries per site per level (~60 bytes each).
    if n <= max_broadcast_sites and 27 * n * max(len(hs), 1) <= max_broadcast_entries:
        small = True
    else:
        small = False
    if small and form == "array":
        best = _nearest_broadcast(pts, s, hs, form, payload)
    else:
        # Each place is searched once and its answer joined back to every
        # point there, whatever the points' ids: NULL, repeated or unique.
        places = pts.drop(point_id).dropDuplicates(["_plon", "_plat"])
        if small:
            found = _nearest_broadcast(places, s, hs, form, payload)
        else:
            found = _nearest_shuffled(places, s, payload)
        best = pts.join(found.select("_plon", "_plat", "_best"), ["_plon", "_plat"])
    return best.select(
        F.col(point_id),
        F.col("_best.k").cast(key_type).alias(site_key),
        F.col("_best.d").alias(distance_col),
        *[F.col(f"_best.{c}").alias(c) for c in payload],
    )


def _nearest_broadcast(pts: DataFrame, s: DataFrame, hs: list[float], form: str, payload: list[str]) -> DataFrame:
    # What a resolved point holds: its best site, or those the window ranks.
    done = "_best" if form == "array" else "_list"
    cur = pts
    for r, h in enumerate(hs):
        table = (
            _neighbour_rows(s, h, payload)
            .groupBy(F.col("_cell").alias(f"_c{r}"))
            .agg(F.collect_list(_entry(payload)).alias(f"_cands{r}"))
        )
        key = cell_key("_px", "_py", "_pz", h)
        if r > 0:
            key = F.when(F.col(done).isNull(), key)
        cur = cur.withColumn(f"_k{r}", key).join(
            F.broadcast(table), F.col(f"_k{r}") == F.col(f"_c{r}"), "left"
        )
        b, t = _pick_sql(f"_cands{r}", f"_b{r}", payload)
        cur = cur.withColumn(f"_b{r}", b)
        own = t if form == "array" else _closest(f"_cands{r}", f"_b{r}")
        cur = cur.withColumn(f"_t{r}", own)
        hit = F.when(_within(F.col(f"_b{r}"), h), F.col(f"_t{r}"))
        cur = cur.withColumn(done, hit if r == 0 else F.coalesce(F.col(done), hit))
        cur = cur.drop(f"_k{r}", f"_c{r}", f"_cands{r}", f"_b{r}", f"_t{r}")
    # Whatever the levels left open is resolved against every site: the site
    # list is a scalar subquery, evaluated once; its size was checked
    # against the bound.  Resolved points never evaluate it.
    every = s.agg(F.collect_list(_entry(payload))).scalar()
    cur = cur.withColumn("_all", F.when(F.col(done).isNull(), every) if hs else every)
    b, brute = _pick_sql("_all", "_ab", payload)
    cur = cur.withColumn("_ab", b)
    if form == "array":
        return cur.withColumn("_best", F.coalesce(F.col("_best"), brute) if hs else brute)
    rest = _closest("_all", "_ab")
    todo = F.coalesce(F.col("_list"), rest) if hs else rest
    exploded = cur.select(*pts.columns, F.explode(todo).alias("_s")).withColumn(
        "_best", _exact_of_entry(F.col("_s"), payload)
    )
    w = Window.partitionBy("_plon", "_plat").orderBy(F.col("_best.d"), F.col("_best.k"))
    return exploded.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)


_BOX = ("_x0", "_y0", "_z0", "_x1", "_y1", "_z1")
_REP = ("_rx", "_ry", "_rz")


def _summaries(df: DataFrame, child: Column, lo: tuple, hi: tuple, rep: tuple, h: float) -> DataFrame:
    """(cube, tight box, central site, children) of every cube of one level, materialised."""
    box = [F.min(c).alias(b) for c, b in zip(lo, _BOX[:3])] + [F.max(c).alias(b) for c, b in zip(hi, _BOX[3:])]
    off = [F.pow(F.col(c) / h - F.floor(F.col(c) / h) - 0.5, 2) for c in rep]
    central = F.min(F.struct((off[0] + off[1] + off[2]).alias("off"), *[F.col(c).alias(r) for c, r in zip(rep, _REP)]))
    cubes = df.groupBy(F.expr(cell_key_sql(*lo, h)).alias("_cube")).agg(
        *box, central.alias("_central"), F.collect_list(child).alias("_children")
    )
    reps = [F.col(f"_central.{r}").alias(r) for r in _REP]
    return cubes.select("_cube", *_BOX, *reps, "_children", F.lit(h).alias("_edge")).checkpoint()


def _cube_tree(s: DataFrame, payload: list[str], leaf_sites: int = _LEAF) -> list[DataFrame]:
    """Levels of cubes from the finest, whose children are the sites, up to one
    of at most ``_TOP`` cubes; a coarser cube's children are cubes."""
    census = _census(s)
    j = _SCALES.index(_finest(_SCALES[0], {k: m for k, (m, _) in census.items()}, leaf_sites))
    own = ("_sx", "_sy", "_sz")
    tree = [_summaries(s, _entry(payload), own, own, own, _SCALES[j])]
    step = int(math.log2(_FACTOR))
    while census[j][1] > _TOP and j > 0:
        j = max(j - step, 0)
        child = F.struct("_cube", *_BOX, *_REP)
        tree.append(_summaries(tree[-1], child, _BOX[:3], _BOX[3:], _REP, _SCALES[j]))
    return tree


def _near_sql(e: str) -> str:
    """Least squared distance from the point to the box of ``e``."""
    axes = [f"greatest(0D, {e}._{c}0 - _p{c}, _p{c} - {e}._{c}1)" for c in "xyz"]
    return " + ".join(f"pow({a}, 2)" for a in axes)


# Slack of a bound on squared distances, for ties and the rounding of the
# products below (a few 1e-16).
_SLACK = 4e-15


def _keep_sql(boxes: str, radius: str = "0D") -> str:
    """(l, kept): a bound on the squared distance from the point to the nearest
    site of any place within ``radius`` of it, seen from the point, and the cubes
    among array column ``boxes`` that may hold one, as (near, e).

    The least distance to a central site is found by products, as its vector has
    length 1.  Most boxes are told to be beyond the bound on one axis alone."""
    dots = f"transform({boxes}, e -> _px * e._rx + _py * e._ry + _pz * e._rz)"
    far = f"greatest(0D, _px * _px + _py * _py + _pz * _pz + 1D - 2D * array_max({dots}))"
    bound = f"pow(sqrt({far}) + 2D * {radius}, 2) * {1.0 + 4 * _TIE!r}D + {_SLACK!r}D"
    reach = ", ".join(f"'{c}0', _p{c} - 1.000001D * sqrt(l), '{c}1', _p{c} + 1.000001D * sqrt(l)" for c in "xyz")
    meets = " and ".join(f"e._{c}0 <= w.{c}1 and e._{c}1 >= w.{c}0" for c in "xyz")
    near = f"filter({boxes}, e -> {meets} and {_near_sql('e')} <= w.l)"
    kept = f"transform({near}, e -> named_struct('near', {_near_sql('e')}, 'e', e))"
    return f"transform(transform(array({bound}), l -> named_struct('l', l, {reach})), w -> named_struct('l', w.l, 'kept', {kept}))[0]"


def _with_least_sql(array: str, value: str) -> str:
    """One-element array of (q: the array, m: its least ``value``), so that
    both are built once and not per element."""
    return f"transform(array({array}), q -> named_struct('q', q, 'm', array_min(transform(q, e -> {value}))))"


def _exact_sql(arr: str, payload: list[str]) -> str:
    """Best site of the array by distance, then key, as in :func:`_pick_sql`."""
    near = f"filter(w.q, e -> {_c2_sql('e')} <= w.m * {1.0 + _TIE!r}D)"
    dist = sphere_distance_sql("_plon", "_plat", "e._slon", "e._slat")
    best = f"array_min(transform({near}, e -> named_struct('d', {dist}, {_fields_sql('e', payload)})))"
    return f"transform({_with_least_sql(f'`{arr}`', _c2_sql('e'))}, w -> {best})[0]"


_PLACE = ["_px", "_py", "_pz", "_plon", "_plat"]


def _cells(places: DataFrame) -> DataFrame:
    """(_cell, middle of the tight box of its places, half its diagonal)."""
    axes = ("_px", "_py", "_pz")
    box = [f(c).alias(f"{c}_{n}") for c in axes for n, f in (("lo", F.min), ("hi", F.max))]
    half = sum((F.pow((F.col(f"{c}_hi") - F.col(f"{c}_lo")) / 2, 2) for c in axes), F.lit(0.0))
    middle = [((F.col(f"{c}_lo") + F.col(f"{c}_hi")) / 2).alias(c) for c in axes]
    return places.groupBy("_cell").agg(*box).select("_cell", *middle, F.sqrt(half).alias("_radius"))


def _open_cubes(places: DataFrame, tree: list[DataFrame]) -> DataFrame:
    """Every place with the finest cubes that may hold its nearest site, one row
    per cube (``_cube``)."""
    edge = tree[0].select("_edge").first()[0]
    celled = places.select(*_PLACE, F.expr(cell_key_sql("_px", "_py", "_pz", edge)).alias("_cell"))
    cell = ["_cell", "_px", "_py", "_pz", "_radius"]
    # Few boxes (counted while the tree was built), as one array.
    every = tree[-1].agg(F.collect_list(F.struct("_cube", *_BOX, *_REP))).scalar()
    cur = _cells(celled).select(*cell, every.alias("_boxes"))
    cur = cur.select(*cell, F.expr(_keep_sql("_boxes", "_radius")).alias("_in")).select(*cell, F.expr("_in.kept.e").alias("_boxes"))
    for level in reversed(tree[1:]):
        opened = cur.select(*cell, F.explode("_boxes._cube").alias("_cube")).join(level.select("_cube", "_children"), "_cube")
        kept = opened.select(*cell, F.expr(_keep_sql("_children", "_radius")).alias("_in"))
        cur = kept.groupBy(*cell).agg(F.min("_in.l").alias("l"), F.flatten(F.collect_list("_in.kept")).alias("kept"))
        cur = cur.select(*cell, F.expr("transform(filter(kept, k -> k.near <= l), k -> k.e)").alias("_boxes"))
    own = celled.join(cur.select("_cell", "_boxes"), "_cell").select(*_PLACE, F.expr(_keep_sql("_boxes")).alias("_in"))
    return own.select(*_PLACE, F.explode("_in.kept.e._cube").alias("_cube"))


def _nearest_shuffled(places: DataFrame, s: DataFrame, payload: list[str]) -> DataFrame:
    """Branch and bound over the tree of cubes.

    The sites and each level of the tree are materialised with a reliable
    checkpoint; of the places only those with their open cubes are moved.  In
    the finest cubes the best site of the cube's array is chosen in the row,
    and the best over a place's few cubes by a shuffled ``min``.
    """
    checkpoint_dir(places.sparkSession)
    s = s.checkpoint()
    tree = _cube_tree(s, payload)
    cand = _open_cubes(places, tree).join(tree[0].select("_cube", F.col("_children").alias("_cands")), "_cube")
    best = cand.select(*_PLACE, F.expr(_exact_sql("_cands", payload)).alias("_t"))
    return best.groupBy("_plon", "_plat").agg(F.min("_t").alias("_best"))


def nearest_site_summary(
    nearest: DataFrame,
    site_cols: list[str],
    distance_col: str = "distance_m",
    mean_col: str = "average_distance_km",
    count_col: str = "cnt",
) -> DataFrame:
    """Per site: number of points for which it is nearest and their mean
    distance in km, busiest site first."""
    return (
        nearest.groupBy(*site_cols)
        .agg(
            F.avg(F.col(distance_col) / 1000.0).alias(mean_col),
            F.count(F.lit(1)).alias(count_col),
        )
        .orderBy(F.col(count_col).desc(), *site_cols)
    )


def attach_site_columns(
    nearest: DataFrame, sites: DataFrame, site_key: str, columns: list[str], max_broadcast_rows: int = 1_000_000
) -> DataFrame:
    """Add site attributes by key; the site table is broadcast only when its
    row count is proven within ``max_broadcast_rows``."""
    attrs, _ = bounded_broadcast(sites.select(site_key, *columns), max_broadcast_rows)
    return nearest.join(attrs, site_key, "left")
