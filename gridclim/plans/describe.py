"""The attributes that plans store beside grids, regional means and indices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import axis
from ..operators import combine, indices
from ..session import small_table
from ..sources import metadata
from ..sources.journal import Describe
from ..sources.metadata import Publisher
from . import incremental

FACTS = "dataset string, variable string, region_set string, area array<double>, long_name string, description string, sources string"


def grid_labels(df: DataFrame) -> DataFrame:
    return df.select("year", "time").distinct()


def regional_labels(df: DataFrame) -> DataFrame:
    return df.select("year", "region_set", "time").distinct()


def _day(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd")


def _attributes(meta: DataFrame, old: DataFrame, now: str, publisher: Publisher) -> DataFrame:
    """``dataset, attrs``: all fields of a new dataset, the dynamic ones of a stored one."""
    both = meta.join(old.withColumnRenamed("attrs", "old"), "dataset", "left")
    refreshed = metadata.merge_on_update(F.col("old"), metadata.dynamic(now, publisher))
    return both.select(
        "dataset", F.when(F.col("old").isNull(), _fresh(now, publisher)).otherwise(refreshed).alias("attrs")
    )


def _fresh(now: str, publisher: Publisher) -> Column:
    """The descriptive map; a derived dataset names what it was made from as well."""
    plain = metadata.descriptive(now, publisher)
    source = F.concat(plain["dc:source"], F.lit("; Derived from: "), F.col("sources"))
    return metadata.merged(
        plain, F.when(F.col("sources").isNotNull(), F.create_map(F.lit("dc:source"), source)).otherwise(metadata.empty())
    )


def grid(
    spark: SparkSession, variables: Sequence[str], now: str, *, cells: DataFrame | None = None, publisher: Publisher = Publisher()
) -> Describe:
    """One dataset per variable. ``cells`` gives the extent of a new grid."""

    def describe(old: DataFrame, held: DataFrame) -> DataFrame:
        rows = [(v, v, None, None, None, None, None) for v in variables]
        meta = small_table(spark, rows, FACTS).withColumns(
            {
                "start_date": axis.scalar(held, _day(F.min("time"))),
                "end_date": axis.scalar(held, _day(F.max("time"))),
                "frequency": F.lit(None).cast("string"),
            }
        )
        if cells is not None and old.isEmpty():
            north, west = axis.scalar(cells, F.max("lat")), axis.scalar(cells, F.min("lon"))
            south, east = axis.scalar(cells, F.min("lat")), axis.scalar(cells, F.max("lon"))
            meta = meta.withColumn("area", F.array(north, west, south, east))
        return _attributes(meta, old, now, publisher)

    return describe


def regional(
    spark: SparkSession, variables: Sequence[str], now: str, *, sources: Sequence[str] = (), publisher: Publisher = Publisher()
) -> Describe:
    """One dataset per variable and region set, each with its own span."""

    def describe(old: DataFrame, held: DataFrame) -> DataFrame:
        spans = held.groupBy("region_set").agg(_day(F.min("time")).alias("start_date"), _day(F.max("time")).alias("end_date"))
        meta = spans.select(
            F.explode(F.array(*[F.lit(v) for v in variables])).alias("variable"), "region_set", "start_date", "end_date",
            F.lit(None).cast("array<double>").alias("area"), *[F.lit(None).cast("string").alias(n) for n in ("long_name", "description", "frequency")],
            F.lit("; ".join(sources) if sources else None).cast("string").alias("sources"),
        ).withColumn("dataset", F.concat_ws("/", "variable", "region_set"))
        return _attributes(meta, old, now, publisher)

    return describe


def index(spark: SparkSession, now: str, *, sources: Sequence[str] = (), publisher: Publisher = Publisher()) -> Describe:
    """One dataset per index and region set, with its checkpoints and frequencies.

    A stored one keeps its creation date and first day.
    """

    def describe(old: DataFrame, held: DataFrame) -> DataFrame:
        key = ("index", "region_set")
        spans = held.groupBy(*key).agg(_day(F.min("time")).alias("start_date"), _day(F.max("time")).alias("end_date"))
        points = combine.checkpoint_attributes(held.groupBy(*key, "freq").agg(F.max("period").alias("last_period")), key)
        about = indices.index_table(spark).select("index", F.col("title").alias("long_name"), "description")
        meta = (
            spans.join(points.withColumnRenamed("attrs", "points"), list(key))
            .join(about, "index", "left")
            .withColumns(
                {
                    "dataset": F.concat_ws("/", *key),
                    "variable": F.col("index"),
                    "frequency": F.col("points")["frequencies_used"],
                    "area": F.lit(None).cast("array<double>"),
                    "sources": F.lit("; ".join(sources) if sources else None).cast("string"),
                }
            )
        )
        new = meta.select("dataset", metadata.merged(_fresh(now, publisher), F.col("points")).alias("attrs"))
        merged = incremental.merge_attributes(old, new)
        return new.join(old, "dataset", "left_anti").unionByName(merged)

    return describe
