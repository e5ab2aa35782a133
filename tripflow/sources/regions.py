"""Region polygons from JSON documents.

Regions are a small table ``(name, coordinates)`` where ``coordinates`` is a GeoJSON
MultiPolygon body, ``array<array<array<array<double>>>>`` of ``[lon, lat]`` pairs.  A Polygon
body is wrapped into a one-part MultiPolygon.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MULTIPOLYGON = "array<array<array<array<double>>>>"
POLYGON = "array<array<array<double>>>"

_FEATURE_SCHEMA = (
    "features array<struct<properties: map<string, string>, "
    "geometry: struct<type: string, coordinates: string>>>"
)
_RECORDS_SCHEMA = (
    "records array<struct<fields: struct<name: string, "
    "geo_shape: struct<type: string, coordinates: string>>>>"
)


def _coords(gtype, text):
    return (F.when(F.lower(gtype) == "multipolygon", F.from_json(text, MULTIPOLYGON))
            .when(F.lower(gtype) == "polygon", F.array(F.from_json(text, POLYGON))))


def regions_from_geojson(spark: SparkSession, path: str, name_property: str = "name",
                         names: Sequence[str] | None = None) -> DataFrame:
    """Read a GeoJSON FeatureCollection; keep features whose property ``name_property`` is in
    ``names`` (all when None)."""
    doc = spark.read.option("wholetext", True).text(path)
    feats = doc.select(F.explode(F.from_json("value", _FEATURE_SCHEMA)["features"]).alias("f"))
    out = feats.select(
        F.col("f.properties")[name_property].alias("name"),
        _coords(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("coordinates"))
    if names is not None:
        out = out.filter(F.col("name").isin(list(names)))
    return out.filter(F.col("coordinates").isNotNull())


def regions_from_records(spark: SparkSession, path: str, default_name: str | None = None,
                         first_only: bool = False) -> DataFrame:
    """Read a ``{"records": [{"fields": {"name": .., "geo_shape": {...}}}]}`` document.

    ``first_only`` keeps only ``records[0]``; ``default_name`` names records without one.
    """
    doc = spark.read.option("wholetext", True).text(path)
    recs = doc.select(F.posexplode(F.from_json("value", _RECORDS_SCHEMA)["records"]).alias("i", "r"))
    if first_only:
        recs = recs.filter(F.col("i") == 0)
    return recs.select(
        F.coalesce(F.col("r.fields.name"), F.lit(default_name)).alias("name"),
        _coords(F.col("r.fields.geo_shape.type"), F.col("r.fields.geo_shape.coordinates")).alias("coordinates"),
    ).filter(F.col("coordinates").isNotNull())


def regions_from_rows(spark: SparkSession, rows: Sequence[tuple[str, list]]) -> DataFrame:
    """Region table from in-memory (name, multipolygon coordinates) pairs (small parameters)."""
    def as_float(x):
        return [as_float(v) for v in x] if isinstance(x, (list, tuple)) else float(x)
    return spark.createDataFrame([(n, as_float(c)) for n, c in rows], f"name string, coordinates {MULTIPOLYGON}")
