"""Region outlines from GeoJSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FEATURE = (
    "properties struct<NUTS_ID:string,NAME_LATN:string,CNTR_CODE:string>, "
    "geometry struct<type:string,coordinates:string>"
)
_POLYGON = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"


def read_regions(spark: SparkSession, path: str, region_set: str, lines: bool = False) -> DataFrame:
    """``region_set, region, name, country, rings`` of a feature collection.

    ``lines`` reads one feature per line, which splits over tasks; a collection in
    one document is parsed by one task per file. Rings of all parts of a
    multi-polygon are kept in one list, which the even-odd test allows.
    """
    if lines:
        features = spark.read.schema(_FEATURE).json(path).select(
            F.struct("properties", "geometry").alias("f")
        )
    else:
        nested = _FEATURE.replace("properties ", "properties:").replace("geometry ", "geometry:")
        document = (
            spark.read.schema(f"features array<struct<{nested}>>").option("multiLine", True).json(path)
        )
        features = document.select(F.explode("features").alias("f"))
    return features.select(
        F.lit(region_set).alias("region_set"),
        F.col("f.properties.NUTS_ID").alias("region"),
        F.col("f.properties.NAME_LATN").alias("name"),
        F.col("f.properties.CNTR_CODE").alias("country"),
        rings(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("rings"),
    )


def rings(kind, coordinates):
    """Coordinates in JSON text as rings of points."""

    def points(parts):
        return F.transform(
            parts, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
        )

    return F.when(kind == "Polygon", points(F.from_json(coordinates, _POLYGON))).when(
        kind == "MultiPolygon", points(F.flatten(F.from_json(coordinates, _MULTI)))
    )


def write_features(regions: DataFrame, path: str) -> None:
    """One GeoJSON feature per line."""
    ring = F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.col("region").alias("NUTS_ID"),
            F.col("name").alias("NAME_LATN"),
            F.col("country").alias("CNTR_CODE"),
        ).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), ring.alias("coordinates")).alias("geometry"),
    )
    regions.select(F.to_json(feature).alias("value")).write.text(path)
