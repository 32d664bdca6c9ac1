"""Places and texts derived from the driver's tables.

The driver's tables hold no coordinates, polygons, currency or date text, so
the analyses are pointed at values derived from them by integer arithmetic
that Spark and an SQL engine evaluate alike.  Each derivation grows with its
source table.  Literals are doubles (``e0``) in the SQL twins so both
engines compute in double precision and in the same order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The study area (lower-left corner and size in degrees) and
# the multipliers/moduli that scatter ids over it.
LON0, LAT0 = -118.67, 33.70
LON_SPAN, LAT_SPAN = 0.52, 0.64
ZONE_W, ZONE_H = 0.104, 0.128  # nation zones: a 5 x 5 grid of such boxes
# supplier zones: half-width 0.002 + 0.001 * (key mod 4) degrees, height 1.25x
SITE_ZONE_W, SITE_ZONE_STEP, SITE_ZONE_ASPECT = 0.002, 0.001, 1.25


def _scatter(expr: Column, modulus: int, origin: float, span: float) -> Column:
    return F.lit(origin) + (expr % F.lit(modulus)) / F.lit(float(modulus)) * F.lit(span)


def event_points(events: DataFrame) -> DataFrame:
    """events -> (event_id, user_id, ts, lon, lat)."""
    uid, eid = F.col("user_id"), F.col("event_id")
    return events.select(
        "event_id",
        "user_id",
        "ts",
        _scatter((uid % 10007) * 7919 + (eid % 10007) * 104729, 10007, LON0, LON_SPAN).alias("lon"),
        _scatter((eid % 10009) * 15485863, 10009, LAT0, LAT_SPAN).alias("lat"),
    )


def user_home(user_id: Column) -> tuple[Column, Column]:
    """A fixed home point per user id."""
    return (
        _scatter((user_id % 10007) * 7919, 10007, LON0, LON_SPAN),
        _scatter((user_id % 10009) * 15485863, 10009, LAT0, LAT_SPAN),
    )


def supplier_sites(supplier: DataFrame) -> DataFrame:
    """Every supplier as a site: (site_key, site_name, site_lon, site_lat)."""
    k = F.col("s_suppkey")
    return supplier.select(
        k.alias("site_key"),
        F.col("s_name").alias("site_name"),
        _scatter((k % 97) * 7919, 97, LON0, LON_SPAN).alias("site_lon"),
        _scatter((k % 89) * 104729, 89, LAT0, LAT_SPAN).alias("site_lat"),
    )


def _diamond(cx: Column, cy: Column, a: Column, b: Column) -> Column:
    """Closed ring [[x, y], ...] of the diamond with centre (cx, cy) and half-widths (a, b)."""
    pts = [(cx, cy - b), (cx + a, cy), (cx, cy + b), (cx - a, cy), (cx, cy - b)]
    return F.array(*[F.array(x, y) for x, y in pts])


def nation_zone_geojson(nation: DataFrame) -> DataFrame:
    """nation -> (n_nationkey, n_name, n_regionkey, geojson) with one GeoJSON
    Feature text per nation.  The zone is a diamond in the nation's grid box;
    region 1 nations get a hole (half-size diamond), region 2 nations are a
    MultiPolygon of two small disjoint diamonds."""
    k = F.col("n_nationkey")
    x0 = F.lit(LON0) + F.lit(ZONE_W) * (k % 5)
    y0 = F.lit(LAT0) + F.lit(ZONE_H) * F.floor(k / F.lit(5.0)).cast("int")
    a, b = F.lit(ZONE_W / 2), F.lit(ZONE_H / 2)
    cx, cy = x0 + a, y0 + b
    outer = _diamond(cx, cy, a, b)
    hole = _diamond(cx, cy, a * 0.5, b * 0.5)
    left = _diamond(cx - a * 0.5, cy, a * 0.4, b * 0.4)
    right = _diamond(cx + a * 0.5, cy, a * 0.4, b * 0.4)
    region = F.col("n_regionkey")
    geom_type = F.when(region == 2, "MultiPolygon").otherwise("Polygon")
    coords = (
        F.when(region == 1, F.to_json(F.array(outer, hole)))
        .when(region == 2, F.to_json(F.array(F.array(left), F.array(right))))
        .otherwise(F.to_json(F.array(outer)))
    )
    feature = F.concat(
        F.lit('{"type":"Feature","properties":'),
        F.to_json(F.struct(k.alias("zone_id"), F.col("n_name").alias("name"))),
        F.lit(',"geometry":{"type":"'),
        geom_type,
        F.lit('","coordinates":'),
        coords,
        F.lit("}}"),
    )
    return nation.select("n_nationkey", "n_name", "n_regionkey", feature.alias("geojson"))


def _feature_text(zone_id: Column, name: Column, geom_type: Column, coords_json: Column) -> Column:
    return F.concat(
        F.lit('{"type":"Feature","properties":'),
        F.to_json(F.struct(zone_id.alias("zone_id"), name.alias("name"))),
        F.lit(',"geometry":{"type":"'),
        geom_type,
        F.lit('","coordinates":'),
        coords_json,
        F.lit("}}"),
    )


def supplier_zone_geojson(supplier: DataFrame, null_every: int | None = None) -> DataFrame:
    """supplier -> (s_suppkey, s_name, geojson): one zone per supplier, a
    diamond around its site whose size steps with the key; keys with
    remainder 1 mod 3 get a hole, remainder 2 a two-part MultiPolygon.
    With ``null_every``, its multiples render a null geometry."""
    k = F.col("s_suppkey")
    cx = _scatter((k % 97) * 7919, 97, LON0, LON_SPAN)
    cy = _scatter((k % 89) * 104729, 89, LAT0, LAT_SPAN)
    a = F.lit(SITE_ZONE_W) + F.lit(SITE_ZONE_STEP) * (k % 4)
    b = a * F.lit(SITE_ZONE_ASPECT)
    kind = k % 3
    outer = _diamond(cx, cy, a, b)
    coords = (
        F.when(kind == 1, F.to_json(F.array(outer, _diamond(cx, cy, a * 0.5, b * 0.5))))
        .when(
            kind == 2,
            F.to_json(
                F.array(
                    F.array(_diamond(cx - a * 0.5, cy, a * 0.4, b * 0.4)),
                    F.array(_diamond(cx + a * 0.5, cy, a * 0.4, b * 0.4)),
                )
            ),
        )
        .otherwise(F.to_json(F.array(outer)))
    )
    geom_type = F.when(kind == 2, "MultiPolygon").otherwise("Polygon")
    feature = _feature_text(k, F.col("s_name"), geom_type, coords)
    if null_every is not None:
        empty = F.concat(
            F.lit('{"type":"Feature","properties":'),
            F.to_json(F.struct(k.alias("zone_id"), F.col("s_name").alias("name"))),
            F.lit(',"geometry":null}'),
        )
        feature = F.when(k % null_every == 0, empty).otherwise(feature)
    return supplier.select("s_suppkey", "s_name", feature.alias("geojson"))


def nation_customers(customer: DataFrame) -> DataFrame:
    """Per nation: customer count and the mean balance in whole cents (floor)."""
    return customer.groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.floor(
            F.sum(F.round(F.col("c_acctbal") * 100).cast("long")) / F.count(F.lit(1))
        ).alias("mean_cents"),
    )


def income_by_zip(customer: DataFrame) -> DataFrame:
    """(zip_code, income_text): the nation's mean balance as currency text ("$4,512.07")."""
    c = nation_customers(customer)
    return c.select(
        F.col("nationkey").cast("string").alias("zip_code"),
        F.concat(F.lit("$"), F.format_number(F.col("mean_cents") / F.lit(100.0), 2)).alias("income_text"),
    )


def rendered_order_dates(orders: DataFrame) -> DataFrame:
    """(o_orderkey, date_text): finished orders in the first record layout,
    open ones in the second, pending ones as unparseable text."""
    d = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(d, "yyyy MMM dd hh:mm:ss a"))
        .when(F.col("o_orderstatus") == "O", F.date_format(d, "MM/dd/yyyy hh:mm:ss a"))
        .otherwise(F.lit("unknown"))
    )
    return orders.select("o_orderkey", text.alias("date_text"))


def rendered_balances(customer: DataFrame) -> DataFrame:
    """(c_custkey, balance_text): "$1,234.56", or "-" for a negative balance."""
    b = F.col("c_acctbal")
    return customer.select(
        "c_custkey",
        F.when(b < 0, F.lit("-")).otherwise(F.concat(F.lit("$"), F.format_number(b, 2))).alias("balance_text"),
    )


# --- SQL twins (DuckDB dialect) ----------------------------------------------

SQL_EVENT_POINTS = f"""
SELECT event_id, user_id, ts,
       {LON0}e0 + (((user_id % 10007)*7919 + (event_id % 10007)*104729) % 10007)/10007e0*{LON_SPAN}e0 AS lon,
       {LAT0}e0 + (((event_id % 10009)*15485863) % 10009)/10009e0*{LAT_SPAN}e0 AS lat
FROM events"""

SQL_SUPPLIER_SITES = f"""
SELECT s_suppkey AS site_key, s_name AS site_name,
       {LON0}e0 + (((s_suppkey % 97)*7919) % 97)/97e0*{LON_SPAN}e0 AS site_lon,
       {LAT0}e0 + (((s_suppkey % 89)*104729) % 89)/89e0*{LAT_SPAN}e0 AS site_lat
FROM supplier"""

SQL_ZONE_FRAME = f"""
SELECT n_nationkey, n_name, n_regionkey,
       {LON0}e0 + {ZONE_W}e0*(n_nationkey % 5) + {ZONE_W / 2}e0 AS cx,
       {LAT0}e0 + {ZONE_H}e0*CAST(floor(n_nationkey/5e0) AS INTEGER) + {ZONE_H / 2}e0 AS cy,
       {ZONE_W / 2}e0 AS a, {ZONE_H / 2}e0 AS b
FROM nation"""

SQL_SUPPLIER_ZONE_FRAME = f"""
SELECT s_suppkey, s_name, s_suppkey % 3 AS kind, cx, cy, a, a * {SITE_ZONE_ASPECT}e0 AS b
FROM (
    SELECT s_suppkey, s_name,
           {LON0}e0 + (((s_suppkey % 97)*7919) % 97)/97e0*{LON_SPAN}e0 AS cx,
           {LAT0}e0 + (((s_suppkey % 89)*104729) % 89)/89e0*{LAT_SPAN}e0 AS cy,
           {SITE_ZONE_W}e0 + {SITE_ZONE_STEP}e0 * (s_suppkey % 4) AS a
    FROM supplier
)"""

SQL_NATION_CUSTOMERS = """
SELECT c_nationkey AS nationkey, COUNT(*) AS n_customers,
       CAST(floor(SUM(CAST(round(c_acctbal*100) AS BIGINT)) / COUNT(*)) AS BIGINT) AS mean_cents
FROM customer GROUP BY c_nationkey"""


def sql_distance_m(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"2*6371008e0*asin(sqrt(least(1e0, pow(sin(radians({lat2}-{lat1})/2),2) + "
        f"cos(radians({lat1}))*cos(radians({lat2}))*pow(sin(radians({lon2}-{lon1})/2),2))))"
    )


def sql_spark_round(x: str, digits: int) -> str:
    """Spark's ROUND of a double: half-up on its shortest decimal text (so
    1.005 -> 1.01), where a plain SQL round works on the binary value."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def sql_round_sig(x: str, digits: int = 9) -> str:
    e = f"floor(log10(abs({x})))"
    s = f"pow(10e0, abs({e}))"
    d = digits - 1
    return (
        f"(CASE WHEN {x} = 0 THEN 0e0 WHEN {e} >= 0 THEN round({x} / {s}, {d}) * {s} "
        f"ELSE round({x} * {s}, {d}) / {s} END)"
    )


def sql_diamond_inside(px: str, py: str, cx: str, cy: str, a: str, b: str) -> str:
    return f"(abs({px} - ({cx}))/({a}) + abs({py} - ({cy}))/({b}) < 1)"


def sql_zone_contains(px: str, py: str, kind: str = "z.n_regionkey") -> str:
    """Containment in the zone (z.*) written analytically, independent of the
    edge-based test used on the Spark side; ``kind`` is 1 with a hole, 2 in two parts."""
    outer = sql_diamond_inside(px, py, "z.cx", "z.cy", "z.a", "z.b")
    in_hole_or_edge = f"(abs({px} - z.cx)/(z.a*0.5e0) + abs({py} - z.cy)/(z.b*0.5e0) <= 1)"
    left = sql_diamond_inside(px, py, "z.cx - z.a*0.5e0", "z.cy", "z.a*0.4e0", "z.b*0.4e0")
    right = sql_diamond_inside(px, py, "z.cx + z.a*0.5e0", "z.cy", "z.a*0.4e0", "z.b*0.4e0")
    return (
        f"(CASE WHEN {kind} = 1 THEN {outer} AND NOT {in_hole_or_edge} "
        f"WHEN {kind} = 2 THEN {left} OR {right} ELSE {outer} END)"
    )
