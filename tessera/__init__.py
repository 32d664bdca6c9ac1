"""tessera: place-and-record analytics as plain Spark DataFrame functions.

Every analysis is a function ``DataFrame(s) -> DataFrame`` built from
Spark SQL expressions, joins, aggregates and windows, so Catalyst plans
it and the caller decides when to run it.

Layout
------
``sources``    explicit-schema readers (CSV, text lines, GeoJSON, parquet tables)
``functions``  column expressions (bands, currency/date parsing, geometry, statistics)
``operators``  the analyses (band counts, top-n share, code frequency,
               nearest site, points in zones, area statistics)
``plans``      the registered queries over the driver's tables and their SQL oracles
``streaming``  notes on using the operators on streaming DataFrames
"""

from tessera.session import build_session, checkpoint_dir, bounded_broadcast

__all__ = ["build_session", "checkpoint_dir", "bounded_broadcast"]
