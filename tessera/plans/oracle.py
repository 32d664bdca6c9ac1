"""SQL twins of the registered queries, in the DuckDB dialect, over the
driver's tables as views.  Where possible the SQL reaches the answer by a
different route than the Spark plan (brute force instead of the grid search,
closed-form diamond tests instead of edge crossings, the source columns
instead of rendered-then-parsed text), so agreement is a real check.
"""

from __future__ import annotations

from tessera.functions.parse import NON_WS_CLASS, WS_CLASS
from tessera.plans import queries as Q
from tessera.plans.derived import (
    SQL_EVENT_POINTS,
    SQL_NATION_CUSTOMERS,
    SQL_SUPPLIER_SITES,
    SQL_SUPPLIER_ZONE_FRAME,
    SQL_ZONE_FRAME,
    sql_distance_m,
    sql_round_sig,
    sql_spark_round,
    sql_zone_contains,
)

_BAND = """CASE WHEN p_size < 18 THEN 'Children'
            WHEN p_size >= 18 AND p_size <= 24 THEN 'Young Adults'
            WHEN p_size >= 25 AND p_size <= 64 THEN 'Adults'
            ELSE 'Elderly' END"""

BAND_COUNTS = f"""
SELECT {_BAND} AS band, COUNT(*) AS cnt
FROM part
WHERE p_size IS NOT NULL AND p_size > 0 AND p_name IS NOT NULL AND p_name <> ''
  AND contains(p_name, '{Q.PART_NAME_CONTAINS}')
GROUP BY 1"""

BAND_COUNTS_FRACTIONAL = f"""
SELECT {_BAND.replace('p_size', 'v')} AS band, COUNT(*) AS cnt
FROM (SELECT p_size * 1.5e0 AS v FROM part) WHERE v IS NOT NULL AND v > 0
GROUP BY 1"""


def _topn(share_expr: str) -> str:
    return f"""
WITH g AS (
    SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, n.n_name AS category, COUNT(*) AS cnt
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    GROUP BY 1, 2
), w AS (
    SELECT year, category, cnt,
           SUM(cnt) OVER (PARTITION BY year) AS total,
           ROW_NUMBER() OVER (PARTITION BY year ORDER BY cnt DESC, category) AS rn
    FROM g
)
SELECT year, category, cnt, {share_expr} AS share FROM w WHERE rn <= {Q.TOP_N}"""


TOPN_SHARE = _topn(sql_spark_round("(cnt / total) * 100", 2))
TOPN_SHARE_TEXT = _topn("printf('%.2f', (cnt / total) * 100)")

_STRICT = rf"(?s)^({NON_WS_CLASS}+){WS_CLASS}+(.*)$"
_LINES = "SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark"

DICTIONARY = f"""
SELECT code, MIN(description) AS description FROM (
    SELECT regexp_extract(line, '{_STRICT}', 1) AS code,
           regexp_extract(line, '{_STRICT}', 2) AS description
    FROM ({_LINES})
) WHERE code <> '' GROUP BY code"""

DICTIONARY_LENIENT = f"""
SELECT code, MIN(description) AS description FROM (
    SELECT regexp_extract(t, '^({NON_WS_CLASS}+)', 1) AS code,
           regexp_extract(t, '(?s)^{NON_WS_CLASS}+{WS_CLASS}+(.*)$', 1) AS description
    FROM (SELECT regexp_replace(line, '^{WS_CLASS}+|{WS_CLASS}+$', '', 'g') AS t FROM ({_LINES}))
) WHERE code <> '' GROUP BY code"""


def _frequency(join: str, dictionary: str) -> str:
    return f"""
WITH t AS (
    SELECT unnest(regexp_split_to_array(text, '{WS_CLASS}+')) AS code
    FROM documents WHERE text IS NOT NULL AND text <> ''
), f AS (
    SELECT code, COUNT(*) AS frequency FROM t WHERE code <> '' GROUP BY code
), d AS ({dictionary})
SELECT f.code, COALESCE(d.description, f.code) AS description, f.frequency
FROM f {join} JOIN d ON f.code = d.code"""


CODE_FREQUENCY = _frequency("LEFT", DICTIONARY)
CODE_FREQUENCY_INNER = _frequency("INNER", DICTIONARY_LENIENT)

SPHERE_DISTANCE = f"""
SELECT event_id, user_id, round({sql_distance_m('lon', 'lat', 'hlon', 'hlat')}, 3) AS metres
FROM (
    SELECT event_id, user_id, lon, lat,
           -118.67e0 + (((user_id % 10007)*7919) % 10007)/10007e0*0.52e0 AS hlon,
           33.7e0 + (((user_id % 10009)*15485863) % 10009)/10009e0*0.64e0 AS hlat
    FROM ({SQL_EVENT_POINTS})
)"""

# Brute force: every point against every site, best by (distance, key).
_NEAREST = f"""
WITH p AS ({SQL_EVENT_POINTS}), s AS ({SQL_SUPPLIER_SITES}),
d AS (
    SELECT p.event_id, s.site_key, s.site_name,
           {sql_distance_m('p.lon', 'p.lat', 's.site_lon', 's.site_lat')} AS dm
    FROM p CROSS JOIN s
    WHERE NOT (p.lat = 0 AND p.lon = 0) AND s.site_lon IS NOT NULL AND s.site_lat IS NOT NULL
), r AS (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY dm, site_key) AS rn FROM d
)"""

NEAREST_SITE = _NEAREST + """
SELECT event_id, site_key, site_name, round(dm / 1000e0, 6) AS km FROM r WHERE rn = 1"""

NEAREST_SITE_SUMMARY = _NEAREST + f"""
SELECT site_key, site_name, {sql_round_sig('avg(dm / 1000e0)')} AS average_distance_km, COUNT(*) AS cnt
FROM r WHERE rn = 1 GROUP BY site_key, site_name"""

# The rendered dates of finished and open orders must parse back to their
# own year; pending ones are unparseable.
YEAR_WINDOW = f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS cnt
FROM orders
WHERE o_orderstatus IN ('F', 'O') AND year(o_orderdate) BETWEEN {Q.YEAR_WINDOW[0]} AND {Q.YEAR_WINDOW[1]}
GROUP BY 1"""

REJECT_COUNTS = f"""
SELECT 'rows' AS rule, COUNT(*) AS n FROM orders
UNION ALL SELECT 'unparsed_date', COUNT(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O') OR o_orderdate IS NULL
UNION ALL SELECT 'outside_window', COUNT(*) FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND year(o_orderdate) NOT BETWEEN {Q.YEAR_WINDOW[0]} AND {Q.YEAR_WINDOW[1]}"""

CSV_TYPED_ROWS = """
SELECT CAST(o_orderkey AS BIGINT) AS key, o_orderstatus || ', "q"' AS status, CAST(o_totalprice AS DOUBLE) AS price FROM orders"""

CURRENCY_PARSE = """
SELECT c_custkey, c_acctbal AS amount FROM customer WHERE c_acctbal >= 0"""

ZONES_FROM_GEOJSON = f"""
SELECT s_suppkey AS zone_id, s_name AS zone_name,
       CASE WHEN kind = 2 THEN 'MultiPolygon' ELSE 'Polygon' END AS geom_type,
       CAST(CASE WHEN kind IN (1, 2) THEN 8 ELSE 4 END AS INTEGER) AS n_edges,
       round(CASE WHEN kind = 2 THEN (cx - a*0.5e0) - a*0.4e0 ELSE cx - a END, 6) AS min_x,
       round(CASE WHEN kind = 2 THEN cy - b*0.4e0 ELSE cy - b END, 6) AS min_y,
       round(CASE WHEN kind = 2 THEN (cx + a*0.5e0) + a*0.4e0 ELSE cx + a END, 6) AS max_x,
       round(CASE WHEN kind = 2 THEN cy + b*0.4e0 ELSE cy + b END, 6) AS max_y
FROM ({SQL_SUPPLIER_ZONE_FRAME})"""

POINTS_IN_ZONES = f"""
WITH p AS ({SQL_EVENT_POINTS}), z AS ({SQL_ZONE_FRAME})
SELECT z.n_nationkey AS zone_id, z.n_name AS zone_name, COUNT(*) AS cnt
FROM p JOIN z ON {sql_zone_contains('p.lon', 'p.lat')}
WHERE p.lat <> 0 AND p.lon <> 0
GROUP BY 1, 2"""

POINTS_IN_SUPPLIER_ZONES = f"""
WITH p AS ({SQL_EVENT_POINTS}), z AS ({SQL_SUPPLIER_ZONE_FRAME})
SELECT z.s_suppkey AS zone_id, z.s_name AS zone_name, COUNT(*) AS cnt
FROM p JOIN z ON {sql_zone_contains('p.lon', 'p.lat', 'z.kind')}
WHERE p.lat <> 0 AND p.lon <> 0 AND z.s_suppkey % {Q.NULL_GEOMETRY_EVERY} <> 0
GROUP BY 1, 2"""

_AREAS = f"""
WITH cust AS ({SQL_NATION_CUSTOMERS}),
blocks AS (
    SELECT z.*, z.n_name AS area, CAST(z.n_nationkey AS VARCHAR) AS zip_code,
           CAST(c.n_customers * 100 AS DOUBLE) AS population
    FROM ({SQL_ZONE_FRAME}) z JOIN cust c ON c.nationkey = z.n_nationkey
    WHERE z.n_name IS NOT NULL AND c.n_customers * 100 > 0
),
income AS (SELECT CAST(nationkey AS VARCHAR) AS zip_code, mean_cents / 100e0 AS income FROM cust),
demo AS (
    SELECT area, SUM(population) AS population,
           SUM(population * income) / SUM(population) AS income
    FROM blocks JOIN income USING (zip_code) GROUP BY area
),
p AS ({SQL_EVENT_POINTS}),
hits AS (
    SELECT z.area, COUNT(*) AS events
    FROM p JOIN blocks z ON {sql_zone_contains('p.lon', 'p.lat')}
    WHERE p.lat <> 0 AND p.lon <> 0
      AND year(p.ts) BETWEEN {Q.EVENT_YEAR_WINDOW[0]} AND {Q.EVENT_YEAR_WINDOW[1]}
    GROUP BY z.area
),
rates AS (
    SELECT demo.area, demo.population, demo.income,
           CAST(COALESCE(hits.events, 0) AS BIGINT) AS events,
           COALESCE(hits.events, 0) / (demo.population * {Q.RATE_YEARS}e0) AS annual_rate
    FROM demo LEFT JOIN hits USING (area)
    WHERE demo.population > 0 AND demo.income IS NOT NULL
)"""

_RATE_COLS = (
    f"area, population, {sql_round_sig('income')} AS income, events, "
    f"{sql_round_sig('annual_rate')} AS annual_rate"
)

ZONE_WEIGHTED_MEAN = _AREAS + f"""
SELECT area, population, {sql_round_sig('income')} AS income FROM demo"""

ZONE_RATES = _AREAS + f"""
SELECT {_RATE_COLS} FROM rates"""

RICHEST_ZONES = _AREAS + f"""
SELECT {_RATE_COLS} FROM (SELECT * FROM rates ORDER BY income DESC, area LIMIT {Q.TOP_K_AREAS})"""

POOREST_ZONES = _AREAS + f"""
SELECT {_RATE_COLS} FROM (SELECT * FROM rates ORDER BY income ASC, area LIMIT {Q.TOP_K_AREAS})"""


def _pearson(x: str, y: str) -> str:
    return (
        f"CASE WHEN COUNT({x} + {y}) > 1 AND var_pop({x}) > 0 AND var_pop({y}) > 0 "
        f"THEN covar_pop({x}, {y}) / sqrt(var_pop({x}) * var_pop({y})) END"
    )


RATE_CORRELATION = _AREAS + f"""
SELECT {sql_round_sig(f"(SELECT {_pearson('income', 'annual_rate')} FROM rates)")} AS corr_all,
       {sql_round_sig(f"(SELECT {_pearson('income', 'annual_rate')} FROM (SELECT * FROM rates ORDER BY income DESC, area LIMIT {Q.TOP_K_AREAS}))")} AS corr_top,
       {sql_round_sig(f"(SELECT {_pearson('income', 'annual_rate')} FROM (SELECT * FROM rates ORDER BY income ASC, area LIMIT {Q.TOP_K_AREAS}))")} AS corr_bottom"""

MOMENTS = f"""
SELECT COUNT(*) AS n,
       {sql_round_sig('avg(l_quantity)')} AS mean_l_quantity,
       {sql_round_sig('avg(l_extendedprice)')} AS mean_l_extendedprice,
       {sql_round_sig('var_pop(l_quantity)')} AS var_l_quantity,
       {sql_round_sig('var_pop(l_extendedprice)')} AS var_l_extendedprice,
       {sql_round_sig('covar_pop(l_quantity, l_extendedprice)')} AS covar_l_quantity_l_extendedprice
FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL"""

CORRELATION = f"""
SELECT {sql_round_sig(f"({_pearson('l_quantity', 'l_extendedprice')})")} AS corr
FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL"""

ORACLE: dict[str, str] = {
    "band_counts_fractional": BAND_COUNTS_FRACTIONAL,
    "band_counts": BAND_COUNTS,
    "band_counts_udf": BAND_COUNTS,
    "topn_share": TOPN_SHARE,
    "topn_share_sql": TOPN_SHARE,
    "topn_share_text": TOPN_SHARE_TEXT,
    "code_dictionary": DICTIONARY,
    "code_dictionary_lenient": DICTIONARY_LENIENT,
    "code_frequency": CODE_FREQUENCY,
    "code_frequency_inner": CODE_FREQUENCY_INNER,
    "join_hint_broadcast": CODE_FREQUENCY,
    "join_hint_merge": CODE_FREQUENCY,
    "join_hint_shuffle_hash": CODE_FREQUENCY,
    "join_hint_replicate_nl": CODE_FREQUENCY,
    "sphere_distance": SPHERE_DISTANCE,
    "nearest_site": NEAREST_SITE,
    "nearest_site_shuffled": NEAREST_SITE,
    "nearest_site_window": NEAREST_SITE,
    "nearest_site_summary": NEAREST_SITE_SUMMARY,
    "year_window": YEAR_WINDOW,
    "csv_typed_rows": CSV_TYPED_ROWS,
    "currency_parse": CURRENCY_PARSE,
    "zones_from_geojson": ZONES_FROM_GEOJSON,
    "zones_from_collection_files": ZONES_FROM_GEOJSON,
    "reject_counts": REJECT_COUNTS,
    "zone_rates_sql": ZONE_RATES,
    "points_in_zones": POINTS_IN_ZONES,
    "points_in_supplier_zones": POINTS_IN_SUPPLIER_ZONES,
    "zone_counts_eager": POINTS_IN_SUPPLIER_ZONES,
    "zone_weighted_mean": ZONE_WEIGHTED_MEAN,
    "zone_rates": ZONE_RATES,
    "richest_zones": RICHEST_ZONES,
    "poorest_zones": POOREST_ZONES,
    "moments": MOMENTS,
    "correlation": CORRELATION,
    "rate_correlation": RATE_CORRELATION,
}
