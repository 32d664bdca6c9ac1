"""Readers with explicit schemas: no inference pass over the data."""

from tessera.sources.csv import (
    CATEGORY_CODE_COLUMNS,
    INCOME_COLUMNS,
    RECORD_COLUMNS,
    SITE_COLUMNS,
    read_csv_columns,
    read_csv_rejects,
    read_csv_schema,
)
from tessera.sources.geojson import read_features
from tessera.sources.rejects import count_rejects
from tessera.sources.split import json_elements
from tessera.sources.tables import read_table
from tessera.sources.text import read_lines, text_lines

__all__ = [
    "CATEGORY_CODE_COLUMNS",
    "INCOME_COLUMNS",
    "RECORD_COLUMNS",
    "SITE_COLUMNS",
    "count_rejects",
    "json_elements",
    "read_csv_columns",
    "read_csv_rejects",
    "read_csv_schema",
    "read_features",
    "read_table",
    "read_lines",
    "text_lines",
]
