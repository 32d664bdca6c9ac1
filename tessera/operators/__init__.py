"""The analyses, each a function from DataFrames to a DataFrame."""

from tessera.operators.bands import band_counts, band_counts_udf
from tessera.operators.codes import code_frequency, explode_codes, parse_code_dictionary
from tessera.operators.nearest import attach_site_columns, nearest_site, nearest_site_summary
from tessera.operators.stats import (
    area_rates,
    correlation,
    moments,
    subset_correlations,
    top_areas,
    weighted_mean_by_area,
)
from tessera.operators.topn import topn_share, topn_share_sql
from tessera.operators.zones import (
    ZoneCells,
    clip_zones,
    count_points_in_zones,
    points_in_zones,
    with_bbox,
    zones_from_geojson,
)

__all__ = [
    "band_counts",
    "band_counts_udf",
    "code_frequency",
    "explode_codes",
    "parse_code_dictionary",
    "attach_site_columns",
    "nearest_site",
    "nearest_site_summary",
    "area_rates",
    "correlation",
    "moments",
    "subset_correlations",
    "top_areas",
    "weighted_mean_by_area",
    "topn_share",
    "topn_share_sql",
    "ZoneCells",
    "clip_zones",
    "count_points_in_zones",
    "points_in_zones",
    "with_bbox",
    "zones_from_geojson",
]
