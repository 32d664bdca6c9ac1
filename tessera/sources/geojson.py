"""GeoJSON features read with an explicit schema.

``geometry.coordinates`` is declared a STRING so Spark keeps the raw JSON
text for both Polygon and MultiPolygon; :func:`tessera.functions.geo.geojson_edges`
parses it per geometry type.  (Inferring the schema over mixed shapes yields
arrays of strings and loses the numbers.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.split import json_elements, root_type

_SQL_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
}


def feature_schema(properties: Mapping[str, str]) -> T.StructType:
    props = T.StructType([T.StructField(k, _SQL_TYPES[v]) for k, v in properties.items()])
    geometry = T.StructType(
        [T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]
    )
    return T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("properties", props),
            T.StructField("geometry", geometry),
        ]
    )


def read_features(
    spark: SparkSession,
    paths: str | Sequence[str],
    properties: Mapping[str, str],
    layout: str = "auto",
) -> DataFrame:
    """Features as rows: the requested properties, ``geom_type`` and ``coordinates``.

    ``layout="collection"``: FeatureCollection documents, each read by as many
    tasks as it has splits (:mod:`tessera.sources.split`).  ``layout="lines"``:
    one Feature per line.  ``layout="auto"`` looks at the first root object of
    the first file.  A file of the other layout fails the read.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    feature = feature_schema(properties)
    if layout == "auto":
        layout = "lines" if root_type(spark, paths[0]) == "Feature" else "collection"
    if layout == "collection":
        parsed = json_elements(spark, paths).select(F.from_json("json", feature).alias("f"))
        feats = parsed.filter(F.col("f.type") == "Feature")
    elif layout == "lines":
        wrong = F.raise_error(F.lit("a line is not a Feature: read it with layout='collection'?"))
        raw = spark.read.schema(feature).json(paths)
        feats = raw.select(F.when(F.col("type") == "Feature", F.struct("*")).otherwise(wrong.cast(feature)).alias("f"))
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return feats.select(
        *[F.col(f"f.properties.`{k}`").alias(k) for k in properties],
        F.col("f.geometry.type").alias("geom_type"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    )
