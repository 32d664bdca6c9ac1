"""The registered queries: each analysis run over the driver's tables.

Every function takes ``(spark, base_dir)`` and returns a lazy DataFrame over
the whole tables in ``base_dir`` (``<name>.parquet``).  Floating results that
are sums (whose last bits depend on summation order) are rounded to nine
significant digits; per-row distances to fixed decimals.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.functions.geo import sphere_distance_m
from tessera.functions.parse import parse_currency, parse_timestamp_any
from tessera.functions.sql import register_functions
from tessera.functions.stats import round_sig
from tessera.operators.bands import band_counts, band_counts_udf
from tessera.operators.codes import code_frequency, explode_codes, parse_code_dictionary
from tessera.operators.nearest import nearest_site, nearest_site_summary
from tessera.operators.stats import (
    area_rates,
    correlation,
    moments,
    subset_correlations,
    top_areas,
    weighted_mean_by_area,
)
from tessera.operators.topn import topn_share, topn_share_sql
from tessera.operators.zones import ZoneCells, count_points_in_zones, with_bbox, zones_from_geojson
from tessera.plans import derived
from tessera.session import checkpoint_dir
from tessera.sources.geojson import feature_schema, read_features
from tessera.sources.rejects import count_rejects
from tessera.sources.tables import read_table
from tessera.sources.text import text_lines

# Parameters of the registered queries.
PART_NAME_CONTAINS = "ring"
TOP_N = 3
YEAR_WINDOW = (1997, 1998)
EVENT_YEAR_WINDOW = (2023, 2024)
RATE_YEARS = 2.0
TOP_K_AREAS = 10
NULL_GEOMETRY_EVERY = 11

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, base: str, name: str) -> DataFrame:
    return read_table(spark, base, name)


# --- Q1: value bands ---------------------------------------------------------


def q_band_counts(spark, base):
    return band_counts(_t(spark, base, "part"), "p_size", "p_name", PART_NAME_CONTAINS)


def q_band_counts_udf(spark, base):
    return band_counts_udf(_t(spark, base, "part"), "p_size", "p_name", PART_NAME_CONTAINS)


def q_band_counts_fractional(spark, base):
    """Bands of a fractional column: values between two bands fall through."""
    part = _t(spark, base, "part").select((F.col("p_size") * F.lit(1.5)).alias("v"))
    return band_counts(part, "v")


# --- Q2: top categories per year with share ----------------------------------


def _orders_by_customer_year(spark, base) -> DataFrame:
    """Orders pre-aggregated to (customer, year, n) before any join: the big
    side shrinks map-side and a hot customer collapses to one row per year."""
    o = _t(spark, base, "orders")
    return o.groupBy(F.col("o_custkey"), F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _orders_with_nation(spark, base) -> DataFrame:
    c = _t(spark, base, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, base, "nation").select("n_nationkey", "n_name")
    return (
        _orders_by_customer_year(spark, base)
        .join(c, F.col("o_custkey") == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("year", F.col("n_name").alias("category"), "n")
    )


def q_topn_share(spark, base):
    return topn_share(_orders_with_nation(spark, base), "year", "category", TOP_N, weight_col="n")


def q_topn_share_text(spark, base):
    return topn_share(_orders_with_nation(spark, base), "year", "category", TOP_N, weight_col="n", as_text=True)


def q_topn_share_sql(spark, base):
    # Records = orders with their year; lookup = customer x nation names.
    o = _t(spark, base, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    c = _t(spark, base, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, base, "nation").select("n_nationkey", "n_name")
    lookup = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("category")
    )
    out = topn_share_sql(spark, o, lookup, "o_custkey", "c_custkey", "r.year", "category", TOP_N, "tessera_q2")
    return out.select(F.col("grp").alias("year"), "category", "cnt", "share")


# --- Q3: code dictionary and code frequencies --------------------------------


def _dictionary(spark, base, lenient=False) -> DataFrame:
    lines = text_lines(_t(spark, base, "benchmark"), "text")
    return parse_code_dictionary(lines, "value", lenient=lenient)


def _codes(spark, base) -> DataFrame:
    return explode_codes(_t(spark, base, "documents"), "text")


def q_code_dictionary(spark, base):
    return _dictionary(spark, base)


def q_code_dictionary_lenient(spark, base):
    return _dictionary(spark, base, lenient=True)


def q_code_frequency(spark, base):
    return code_frequency(_codes(spark, base), _dictionary(spark, base), how="left")


def q_code_frequency_inner(spark, base):
    return code_frequency(_codes(spark, base), _dictionary(spark, base, lenient=True), how="inner")


def _hinted(hint: str) -> Query:
    def q(spark, base):
        return code_frequency(_codes(spark, base), _dictionary(spark, base), how="left", join_hint=hint)

    q.__name__ = f"q_join_hint_{hint}"
    return q


# --- Q4: distances and nearest site ------------------------------------------


def q_sphere_distance(spark, base):
    p = derived.event_points(_t(spark, base, "events"))
    hlon, hlat = derived.user_home(F.col("user_id"))
    return p.select(
        "event_id",
        "user_id",
        F.round(sphere_distance_m("lon", "lat", hlon, hlat), 3).alias("metres"),
    )


def _nearest(spark, base, form: str, **kw) -> DataFrame:
    pts = derived.event_points(_t(spark, base, "events"))
    # Points at (0, 0) are treated as missing, as in the record files.
    pts = pts.filter((F.col("lat") != 0.0) | (F.col("lon") != 0.0))
    sites = derived.supplier_sites(_t(spark, base, "supplier"))
    return nearest_site(pts, sites, "event_id", site_cols=["site_name"], form=form, **kw)


def _nearest_out(df: DataFrame) -> DataFrame:
    return df.select("event_id", "site_key", "site_name", F.round(F.col("distance_m") / 1000.0, 6).alias("km"))


def q_nearest_site(spark, base):
    return _nearest_out(_nearest(spark, base, "array"))


def q_nearest_site_window(spark, base):
    return _nearest_out(_nearest(spark, base, "window"))


def q_nearest_site_shuffled(spark, base):
    """The plan for site tables beyond the broadcast bound, on all rows."""
    return _nearest_out(_nearest(spark, base, "array", max_broadcast_sites=0))


def q_nearest_site_summary(spark, base):
    s = nearest_site_summary(_nearest(spark, base, "array"), ["site_key", "site_name"])
    return s.select("site_key", "site_name", round_sig("average_distance_km").alias("average_distance_km"), "cnt")


# --- parsing -----------------------------------------------------------------


def q_year_window(spark, base):
    d = derived.rendered_order_dates(_t(spark, base, "orders"))
    ts = parse_timestamp_any("date_text")
    y = d.select(F.year(ts).alias("year")).filter(F.col("year").isNotNull())
    lo, hi = YEAR_WINDOW
    return y.filter(F.col("year").between(lo, hi)).groupBy("year").agg(F.count(F.lit(1)).alias("cnt"))


def q_reject_counts(spark, base):
    """Rows that each rule of the year window turns away, counted while the
    window itself is computed."""
    d = derived.rendered_order_dates(_t(spark, base, "orders")).select(F.year(parse_timestamp_any("date_text")).alias("year"))
    lo, hi = YEAR_WINDOW
    seen = Observation("year_window")
    rules = {"unparsed_date": F.col("year").isNull(), "outside_window": ~F.col("year").between(lo, hi)}
    d = count_rejects(d, rules, seen)
    d.filter(F.col("year").between(lo, hi)).groupBy("year").agg(F.count(F.lit(1)).alias("cnt")).collect()
    return spark.createDataFrame(sorted(seen.get.items()), "rule string, n long")


def q_csv_typed_rows(spark, base):
    """Orders rendered as CSV records, parsed back and typed."""
    o = _t(spark, base, "orders")
    quoted = F.concat(F.lit('"'), F.col("o_orderstatus"), F.lit(', ""q"""'))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), quoted, F.col("o_totalprice").cast("string"))
    # A quote within quotes is written twice, as in the record files.
    r = F.from_csv(line, "key STRING, status STRING, price STRING", {"escape": '"'})
    return o.select(r.alias("r")).select(
        F.col("r.key").try_cast("long").alias("key"), F.col("r.status").alias("status"), F.col("r.price").try_cast("double").alias("price")
    )


def q_currency_parse(spark, base):
    b = derived.rendered_balances(_t(spark, base, "customer"))
    return b.select("c_custkey", parse_currency("balance_text").alias("amount")).filter(
        F.col("amount").isNotNull()
    )


# --- Q5: zones, rates and correlations ---------------------------------------


def _zones(spark, base, materialise: bool = True) -> DataFrame:
    """Nation zones: GeoJSON Feature text parsed with the reader's schema.

    The zone table is a small dimension; it is materialised once with a
    reliable checkpoint (in the session's checkpoint folder) so that the
    render-and-parse expressions are not re-planned and inlined into every
    filter Catalyst pushes down through them."""
    checkpoint_dir(spark)
    g = derived.nation_zone_geojson(_t(spark, base, "nation"))
    f = g.select(F.from_json("geojson", feature_schema({"zone_id": "int", "name": "string"})).alias("f"))
    feats = f.select(
        F.col("f.properties.zone_id").alias("zone_id"),
        F.col("f.properties.name").alias("zone_name"),
        F.col("f.geometry.type").alias("geom_type"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    )
    # Zones without geometry are no zones; dropped on the raw text, before it is parsed.
    feats = feats.filter(F.col("geom_type").isNotNull() & F.col("coordinates").isNotNull())
    zones = zones_from_geojson(feats)
    return zones.checkpoint(eager=True) if materialise else zones


def _supplier_features(spark, base, null_every: int | None = None) -> DataFrame:
    """One parsed GeoJSON feature per supplier."""
    g = derived.supplier_zone_geojson(_t(spark, base, "supplier"), null_every)
    f = g.select(F.from_json("geojson", feature_schema({"zone_id": "long", "name": "string"})).alias("f"))
    return f.select(
        F.col("f.properties.zone_id").alias("zone_id"),
        F.col("f.properties.name").alias("zone_name"),
        F.col("f.geometry.type").alias("geom_type"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    )


def q_zones_from_geojson(spark, base):
    """One GeoJSON feature per supplier, parsed into edges and a box."""
    feats = _supplier_features(spark, base)
    z = with_bbox(zones_from_geojson(feats))
    return z.select(
        "zone_id",
        "zone_name",
        "geom_type",
        F.size("edges").alias("n_edges"),
        *[F.round(c, 6).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")],
    )


def q_zones_from_collection_files(spark, base):
    """The suppliers' features written as FeatureCollection files in the shared
    folder, then read back by splits and parsed."""

    def collections(batches):
        # A partition's texts as the members of one document.
        lead = '{"type": "FeatureCollection", "name": "a \\"{[", "features": [\n'
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"value": [lead + text]})
                lead = ",\n"
        if lead == ",\n":
            yield pa.RecordBatch.from_pydict({"value": ["\n]}\n"]})

    g = derived.supplier_zone_geojson(_t(spark, base, "supplier")).select("geojson")
    folder = f"{checkpoint_dir(spark)}/features-{uuid.uuid4().hex}"
    g.mapInArrow(collections, "value string").write.text(folder)
    feats = read_features(spark, folder, {"zone_id": "long", "name": "string"}, layout="collection")
    z = with_bbox(zones_from_geojson(feats.withColumnRenamed("name", "zone_name")))
    boxes = [F.round(c, 6).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")]
    return z.select("zone_id", "zone_name", "geom_type", F.size("edges").alias("n_edges"), *boxes)


def _event_points(spark, base, window: tuple[int, int] | None = None) -> DataFrame:
    p = derived.event_points(_t(spark, base, "events"))
    # Either coordinate 0 means missing here (the zone analysis is stricter).
    p = p.filter((F.col("lat") != 0.0) & (F.col("lon") != 0.0))
    if window is not None:
        # Plain bounds on the column, so that they reach the scan.
        kind = p.schema["ts"].dataType.simpleString()
        p = p.filter(
            (F.col("ts") >= F.lit(f"{window[0]}-01-01 00:00:00").cast(kind))
            & (F.col("ts") < F.lit(f"{window[1] + 1}-01-01 00:00:00").cast(kind))
        )
    return p.select("lon", "lat")


def q_points_in_zones(spark, base):
    z = _zones(spark, base)
    counts = count_points_in_zones(_event_points(spark, base), z, "zone_id")
    return counts.join(z.select("zone_id", "zone_name"), "zone_id").select("zone_id", "zone_name", "cnt")


def _supplier_zone_counts(spark, base, clip: bool | None = None, **kw):
    feats = _supplier_features(spark, base, NULL_GEOMETRY_EVERY)
    feats = feats.filter(F.col("geom_type").isNotNull() & F.col("coordinates").isNotNull())
    checkpoint_dir(spark)
    z = zones_from_geojson(feats).checkpoint(eager=True)
    cells = ZoneCells(z, "zone_id", clip=clip)
    counts = count_points_in_zones(_event_points(spark, base), cells, "zone_id", **kw)
    return counts.join(z.select("zone_id", "zone_name"), "zone_id").select("zone_id", "zone_name", "cnt")


def q_points_in_supplier_zones(spark, base):
    """Events counted in overlapping zones of several sizes, one per supplier;
    suppliers without geometry are no zones."""
    return _supplier_zone_counts(spark, base, clip=True)


def q_zone_counts_eager(spark, base):
    """The same by the plan for cell tables beyond the broadcast bound: counts
    per cell go through the join, only points in border cells are tested."""
    return _supplier_zone_counts(spark, base, clip=True, max_broadcast_rows=0)


def _blocks(spark, base, z: DataFrame) -> DataFrame:
    """Zones with their area, zip and population; invalid ones dropped before
    any spatial work."""
    cust = derived.nation_customers(_t(spark, base, "customer"))
    b = z.join(cust, z["zone_id"] == cust["nationkey"], "left").select(
        "zone_id",
        F.col("zone_name").alias("area"),
        F.col("zone_id").cast("string").alias("zip_code"),
        (F.col("n_customers") * 100).cast("double").alias("population"),
        "edges",
    )
    return b.filter(
        F.col("area").isNotNull()
        & F.col("zip_code").isNotNull()
        & F.col("population").isNotNull()
        & (F.col("population") > 0)
    )


def _income(spark, base) -> DataFrame:
    i = derived.income_by_zip(_t(spark, base, "customer"))
    return i.select("zip_code", parse_currency("income_text").alias("income")).filter(
        F.col("zip_code").isNotNull() & F.col("income").isNotNull()
    )


def q_zone_weighted_mean(spark, base):
    d = weighted_mean_by_area(_blocks(spark, base, _zones(spark, base)), _income(spark, base))
    return d.select("area", "population", round_sig("income").alias("income"))


def _rates(spark, base) -> DataFrame:
    # The finished block table (zones with population, filtered) is the
    # dimension every later step reads: materialise it once.
    blocks = _blocks(spark, base, _zones(spark, base, materialise=False)).checkpoint(eager=True)
    counts = count_points_in_zones(_event_points(spark, base, EVENT_YEAR_WINDOW), blocks, "area", count_col="events")
    demo = weighted_mean_by_area(blocks, _income(spark, base))
    return area_rates(demo, counts, count_col="events", years=RATE_YEARS)


def _rates_out(df: DataFrame) -> DataFrame:
    return df.select(
        "area",
        "population",
        round_sig("income").alias("income"),
        F.col("events").cast("long").alias("events"),
        round_sig("annual_rate").alias("annual_rate"),
    )


def q_zone_rates(spark, base):
    return _rates_out(_rates(spark, base))


def q_zone_rates_sql(spark, base):
    """The area rates as one SQL text over views and SQL-defined functions."""
    register_functions(spark)
    blocks = _blocks(spark, base, _zones(spark, base, materialise=False)).checkpoint(eager=True)
    cells = ZoneCells(blocks, "area", clip=True)
    views = {"blocks": blocks, "income": _income(spark, base), "cells": cells.cells, "points": _event_points(spark, base, EVENT_YEAR_WINDOW)}
    for name, df in views.items():
        df.createOrReplaceTempView(f"tessera_q5_{name}")
    levels = ", ".join(map(str, cells.levels))
    out = spark.sql(f"""
WITH demo AS (
    SELECT area, population, weighted_mean(weighted, population) AS income
    FROM (SELECT area, SUM(population) AS population, SUM(population * income) AS weighted
          FROM tessera_q5_blocks JOIN tessera_q5_income USING (zip_code)
          GROUP BY area)
),
located AS (SELECT lon, lat, point_cells(lon, lat, array({levels})) AS ks FROM tessera_q5_points),
probes AS (SELECT lon, lat, k FROM located LATERAL VIEW explode(ks) AS k),
hits AS (
    SELECT c.area, COUNT(*) AS events
    FROM probes p JOIN tessera_q5_cells c ON p.k.lvl = c._lvl AND p.k.cx = c._cx AND p.k.cy = c._cy
    WHERE c._edges IS NULL OR zone_contains(c._edges, p.lon, p.lat)
    GROUP BY c.area
)
SELECT d.area, d.population, d.income, COALESCE(h.events, 0) AS events,
       yearly_rate(COALESCE(h.events, 0), d.population, {RATE_YEARS}D) AS annual_rate
FROM demo d LEFT JOIN hits h USING (area)
WHERE d.population > 0 AND d.income IS NOT NULL""")
    return _rates_out(out)


def q_richest_zones(spark, base):
    return _rates_out(top_areas(_rates(spark, base), "income", TOP_K_AREAS, True, "area"))


def q_poorest_zones(spark, base):
    return _rates_out(top_areas(_rates(spark, base), "income", TOP_K_AREAS, False, "area"))


def q_rate_correlation(spark, base):
    c = subset_correlations(_rates(spark, base), "income", "annual_rate", "income", TOP_K_AREAS, "area")
    return c.select(*[round_sig(x).alias(x) for x in ("corr_all", "corr_top", "corr_bottom")])


def q_moments(spark, base):
    m = moments(_t(spark, base, "lineitem"), ["l_quantity", "l_extendedprice"])
    return m.select("n", *[round_sig(c).alias(c) for c in m.columns if c != "n"])


def q_correlation(spark, base):
    c = correlation(_t(spark, base, "lineitem"), "l_quantity", "l_extendedprice")
    return c.select(round_sig("corr").alias("corr"))


QUERIES: dict[str, Query] = {
    "band_counts": q_band_counts,
    "band_counts_udf": q_band_counts_udf,
    "band_counts_fractional": q_band_counts_fractional,
    "topn_share": q_topn_share,
    "topn_share_sql": q_topn_share_sql,
    "topn_share_text": q_topn_share_text,
    "code_dictionary": q_code_dictionary,
    "code_dictionary_lenient": q_code_dictionary_lenient,
    "code_frequency": q_code_frequency,
    "code_frequency_inner": q_code_frequency_inner,
    "join_hint_broadcast": _hinted("broadcast"),
    "join_hint_merge": _hinted("merge"),
    "join_hint_shuffle_hash": _hinted("shuffle_hash"),
    "join_hint_replicate_nl": _hinted("shuffle_replicate_nl"),
    "sphere_distance": q_sphere_distance,
    "nearest_site": q_nearest_site,
    "nearest_site_window": q_nearest_site_window,
    "nearest_site_shuffled": q_nearest_site_shuffled,
    "nearest_site_summary": q_nearest_site_summary,
    "year_window": q_year_window,
    "csv_typed_rows": q_csv_typed_rows,
    "currency_parse": q_currency_parse,
    "zones_from_geojson": q_zones_from_geojson,
    "zones_from_collection_files": q_zones_from_collection_files,
    "reject_counts": q_reject_counts,
    "zone_rates_sql": q_zone_rates_sql,
    "points_in_zones": q_points_in_zones,
    "points_in_supplier_zones": q_points_in_supplier_zones,
    "zone_counts_eager": q_zone_counts_eager,
    "zone_weighted_mean": q_zone_weighted_mean,
    "zone_rates": q_zone_rates,
    "richest_zones": q_richest_zones,
    "poorest_zones": q_poorest_zones,
    "moments": q_moments,
    "correlation": q_correlation,
    "rate_correlation": q_rate_correlation,
}
