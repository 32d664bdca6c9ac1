"""Column expressions shared by the operators."""

from tessera.functions.bands import AGE_BANDS, band_expr, band_labels_pandas
from tessera.functions.geo import (
    EARTH_RADIUS_M,
    edges_bbox,
    geojson_edges,
    polygon_contains,
    sphere_distance_m,
    unit_vector,
)
from tessera.functions.parse import (
    RECORD_DATE_FORMATS,
    parse_currency,
    parse_timestamp_any,
    render_currency,
    split_tokens,
)
from tessera.functions.stats import pearson, round_sig

__all__ = [
    "AGE_BANDS",
    "band_expr",
    "band_labels_pandas",
    "EARTH_RADIUS_M",
    "edges_bbox",
    "geojson_edges",
    "polygon_contains",
    "sphere_distance_m",
    "unit_vector",
    "RECORD_DATE_FORMATS",
    "parse_currency",
    "parse_timestamp_any",
    "render_currency",
    "split_tokens",
    "pearson",
    "round_sig",
]
