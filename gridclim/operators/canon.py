"""Bring a frame to canonical names, coordinates and column order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import axis

# Naming schemes in order of precedence. A scheme applies when its
# marker columns are all present.
SPATIAL_SCHEMES = (
    (("rlon", "longitude"), {"rlon": "x", "rlat": "y", "longitude": "lon", "latitude": "lat"}),
    (("nav_lat",), {"nav_lon": "lon", "nav_lat": "lat"}),
    (("i", "longitude"), {"i": "x", "j": "y", "longitude": "lon", "latitude": "lat"}),
    (("i", "lon"), {"i": "x", "j": "y"}),
    (("rlon",), {"rlon": "x", "rlat": "y"}),
    (("nj",), {"ni": "x", "nj": "y"}),
    (("lon",), {}),
    (("longitude",), {"longitude": "lon", "latitude": "lat"}),
    (("x",), {"x": "lon", "y": "lat"}),
    (("y",), {"x": "lon", "y": "lat"}),
)


def rename_spatial(df: DataFrame) -> DataFrame:
    """Rename coordinate columns by the first scheme whose markers are present."""
    present = set(df.columns)
    for markers, names in SPATIAL_SCHEMES:
        if present.issuperset(markers):
            return df.withColumnsRenamed(names)
    raise NotImplementedError(f"no spatial naming scheme fits the columns {df.columns}")


def rename_time(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("valid_time", "time")


def rename_variable(df: DataFrame, name: str, coordinates: tuple[str, ...] = ("time", "lat", "lon", "x", "y")) -> DataFrame:
    """Rename the only column that is no coordinate."""
    data = [c for c in df.columns if c not in coordinates]
    if len(data) != 1:
        raise ValueError(f"expected one data variable, found {data}")
    return df.withColumnRenamed(data[0], name)


def ensure_coordinate(df: DataFrame, dim: str, values: str) -> DataFrame:
    """Unnest an array variable; without a label array the position is the coordinate.

    ``values`` holds one array per row along ``dim``. When ``dim`` is already a
    column with the labels of that array, they are kept.
    """
    others = [c for c in df.columns if c not in (dim, values)]
    if dim not in df.columns:
        return df.select(*others, F.posexplode_outer(values).alias(dim, values))
    pairs = F.arrays_zip(F.col(dim).alias("label"), F.col(values).alias("value"))
    return df.select(*others, F.explode_outer(pairs).alias("_p")).select(
        *others, F.col("_p.label").alias(dim), F.col("_p.value").alias(values)
    )


def sort_latitudes(df: DataFrame) -> DataFrame:
    """Ascending latitudes inside each task; row order has no meaning before a sink."""
    return df.sortWithinPartitions("lat")


def wrap_longitudes(df: DataFrame) -> DataFrame:
    """[0, 360] to [-180, 180], only when the whole frame uses the former."""
    uses_360 = axis.scalar(df, (F.max("lon") > 180) & (F.min("lon") >= 0))
    return df.withColumn(
        "lon", F.when(uses_360 & (F.col("lon") > 180), F.col("lon") - 360).otherwise(F.col("lon"))
    )


def first_member(df: DataFrame, member: str = "number") -> DataFrame:
    """Keep ensemble member 0."""
    if member not in df.columns:
        return df
    return df.where(F.col(member) == 0).drop(member)


def canonical_order(df: DataFrame) -> DataFrame:
    lead = [c for c in ("time", "lat", "lon") if c in df.columns]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def crop(df: DataFrame, area: tuple[float, float, float, float] | None) -> DataFrame:
    """``(north, west, south, east)`` box, edges included."""
    if area is None:
        return df
    north, west, south, east = area
    return df.where(F.col("lat").between(south, north) & F.col("lon").between(west, east))


def between_dates(df: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Inclusive date range; with a ``year`` column partitions are pruned as well."""
    for bound, op in ((first, "__ge__"), (last, "__le__")):
        if bound is None:
            continue
        df = df.where(getattr(F.col("time"), op)(F.to_date(F.lit(bound))))
        if "year" in df.columns:
            df = df.where(getattr(F.col("year"), op)(int(bound[:4])))
    return df


def canonicalise(df: DataFrame, variable: str) -> DataFrame:
    """All steps, in the order ingestion applies them."""
    df = rename_time(df)
    df = rename_spatial(df)
    df = wrap_longitudes(df)
    df = first_member(df)
    df = canonical_order(df)
    return rename_variable(df, variable)
