"""The library's expressions as SQL-defined functions, so that the analyses can
be written as SQL text.  They are macros that the planner inlines: no Python
worker, and filters and columns are pushed through them as through any text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.functions.bands import AGE_BANDS
from tessera.functions.geo import _ON_EDGE, EDGE_TYPE, sphere_distance_sql


def _band_sql(value: str) -> str:
    *head, last = AGE_BANDS
    arms = []
    for label, lo, hi, *below in head:
        tests = [f"{value} >= {lo}"] * (lo is not None) + [f"{value} <= {hi}"] * (hi is not None)
        tests += [f"{value} < {x}" for x in below]
        arms.append(f"WHEN {' AND '.join(tests)} THEN '{label}'")
    return f"CASE {' '.join(arms)} ELSE '{last[0]}' END"


def _contains_sql() -> str:
    on_edge = (
        "x >= least(s.ax, s.bx) AND x <= greatest(s.ax, s.bx) AND y >= least(s.ay, s.by) AND y <= greatest(s.ay, s.by)"
        " AND (x - s.ax) * (s.by - s.ay) = (y - s.ay) * (s.bx - s.ax)"
    )
    crossed = "CASE WHEN (s.ay > y) != (s.by > y) THEN CASE WHEN x < (s.bx - s.ax) * (y - s.ay) / (s.by - s.ay) + s.ax THEN 1 ELSE 0 END ELSE 0 END"
    step = f"acc + {crossed} + CASE WHEN {on_edge} THEN {_ON_EDGE}L ELSE 0L END"
    verdict = f"acc < {_ON_EDGE}L AND acc % 2 = 1"
    return f"aggregate(edges, 0L, (acc, s) -> {step}, acc -> {verdict})"


def function_texts() -> dict[str, str]:
    """Name -> the rest of its CREATE FUNCTION statement."""
    edges = f"ARRAY<{EDGE_TYPE.simpleString()}>"
    return {
        "age_band": f"(v DOUBLE) RETURNS STRING RETURN {_band_sql('v')}",
        "sphere_distance_m": f"(lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE) RETURNS DOUBLE RETURN {sphere_distance_sql('lon1', 'lat1', 'lon2', 'lat2')}",
        "zone_contains": f"(edges {edges}, x DOUBLE, y DOUBLE) RETURNS BOOLEAN RETURN {_contains_sql()}",
        "point_cells": "(lon DOUBLE, lat DOUBLE, levels ARRAY<INT>) RETURNS ARRAY<STRUCT<lvl: INT, cx: BIGINT, cy: BIGINT>> "
        "RETURN transform(levels, l -> named_struct('lvl', l, 'cx', floor(lon / pow(2D, l)), 'cy', floor(lat / pow(2D, l))))",
        "weighted_mean": "(weighted DOUBLE, weight DOUBLE) RETURNS DOUBLE RETURN try_divide(weighted, weight)",
        "yearly_rate": "(n BIGINT, population DOUBLE, years DOUBLE) RETURNS DOUBLE RETURN try_divide(n, population * years)",
    }


def register_functions(spark: SparkSession) -> None:
    """Define the functions for this session, replacing earlier ones."""
    for name, text in function_texts().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{text}")
