"""Shared pieces of the Spark side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import regions
from ..session import materialise
from ..sources import tables


def r6(value: Column | str) -> Column:
    """Rounded so that the order of a floating sum does not show."""
    return F.round(F.col(value) if isinstance(value, str) else value, 6)


def text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def big(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("bigint")


def flag(value: Column | str) -> Column:
    """A boolean as 0 or 1."""
    return (F.col(value) if isinstance(value, str) else value).cast("int").cast("bigint")


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct cells straight from the supplier keys of the line items."""
    k = F.col("l_suppkey")
    return (
        tables.table(spark, sf, "lineitem")
        .select(tables.cell_lat(k).alias("lat"), tables.cell_lon(k).alias("lon"))
        .distinct()
    )


def xwalk(spark: SparkSession, sf: str) -> DataFrame:
    """The crosswalk as a table, the way a run keeps it; outlines are a table as well."""
    outlines = materialise(tables.regions(spark, sf))
    return materialise(regions.crosswalk(cells(spark, sf), outlines))
