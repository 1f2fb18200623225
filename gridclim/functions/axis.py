"""Coordinate axes: distinct labels, their positions, scalar lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def scalar(df: DataFrame, aggregate: Column) -> Column:
    """One aggregate over a whole frame as a scalar subquery."""
    return df.select(aggregate.alias("v")).scalar()


def labels(df: DataFrame, name: str) -> Column:
    """Sorted distinct labels of a spatial axis as one array.

    Bounded by the extent over the resolution of the grid, not by the rows.
    """
    return scalar(df, F.sort_array(F.collect_set(name)))


def time_axis(df: DataFrame) -> DataFrame:
    """Distinct time labels. Map-side partial distinct leaves few rows to shuffle."""
    return df.select("time").distinct()


def time_positions(df: DataFrame) -> DataFrame:
    """``time, position`` with positions 0, 1, ... in time order.

    Ranks inside each year and adds the size of the years before, so no task sees
    the whole axis; only the list of years is ordered as one.
    """
    axis = time_axis(df).withColumn("axis_year", F.year("time"))
    years = axis.groupBy("axis_year").agg(F.count("*").alias("n"))
    ahead = years.select(
        "axis_year",
        F.coalesce(
            F.sum("n").over(
                Window.partitionBy(F.lit(0))
                .orderBy("axis_year")
                .rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("ahead"),
    )
    in_year = Window.partitionBy("axis_year").orderBy("time")
    return axis.join(ahead, "axis_year").select(
        "time", (F.row_number().over(in_year) - 1 + F.col("ahead")).alias("position")
    )


def position_of(axis: Column, value: Column) -> Column:
    """0-based position of a label on an axis array."""
    return F.array_position(axis, value) - 1


def cell_id(lat: Column, lon: Column) -> Column:
    """One integer per cell, exact to a millionth of a degree.

    Plans that stay inside one cell partition by this: Spark wraps floating keys of
    joins and windows before hashing, so data partitioned by (lat, lon) would be
    exchanged again, data partitioned by an integer is not.
    """
    scaled = F.round(lat * 1e6).cast("bigint") * 1_000_000_000
    return scaled + F.round(lon * 1e6).cast("bigint")
