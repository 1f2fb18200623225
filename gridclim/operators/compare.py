"""Old and new version of a store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric
from . import quality


def value_differences(old: DataFrame, new: DataFrame, variable: str, keys: tuple[str, ...]) -> DataFrame:
    """Common rows, how many agree within tolerance, largest difference."""
    a, b = F.col("_old"), F.col("_new")
    pairs = old.select(*keys, F.col(variable).alias("_old")).join(
        new.select(*keys, F.col(variable).alias("_new")), list(keys)
    )
    # The tolerance is relative to the new value.
    return pairs.agg(
        F.count("*").alias("common"),
        F.count_if(numeric.close_to(a, b)).alias("agree"),
        F.max(F.abs(a - b)).alias("max_abs_diff"),
    ).withColumn("identical", F.col("common") == F.col("agree"))


def attribute_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``dataset, key, status, old_value, new_value`` for every attribute."""

    def entries(df: DataFrame, name: str) -> DataFrame:
        return df.select("dataset", F.explode("attrs").alias("key", name))

    a, b = F.col("old_value"), F.col("new_value")
    status = (
        F.when(a.isNull() & b.isNull(), "Match")
        .when(a.isNull(), "ADDED")
        .when(b.isNull(), "REMOVED")
        .when(a != b, "CHANGED")
        .otherwise("Match")
    )
    return (
        entries(old, "old_value")
        .join(entries(new, "new_value"), ["dataset", "key"], "full")
        .select("dataset", "key", status.alias("status"), "old_value", "new_value")
    )


def dimension_changes(old: DataFrame, new: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """``dim, old_size, new_size, status``."""
    before = quality.profile(old, tuple(d for d in dims if d in old.columns))
    after = quality.profile(new, tuple(d for d in dims if d in new.columns))
    status = (
        F.when(F.col("new_size").isNull(), "MISSING")
        .when(F.col("old_size").isNull(), "ADDED")
        .when(F.col("old_size") == F.col("new_size"), "Match")
        .otherwise("CHANGED")
    )
    return (
        before.withColumnRenamed("size", "old_size")
        .join(after.withColumnRenamed("size", "new_size"), "dim", "full")
        .withColumn("status", status)
    )


def preserved_steps(old: DataFrame, new: DataFrame) -> DataFrame:
    """How many old time steps the new store still has."""
    a, b = old.select("time").distinct(), new.select("time").distinct()
    kept = a.intersect(b).agg(F.count("*").alias("kept"))
    total = a.select(F.count("*").alias("n")).scalar()
    return kept.withColumn("old_steps", total).withColumn(
        "verdict", F.when(F.col("kept") == F.col("old_steps"), "all preserved").otherwise("data loss")
    )


def region_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``region, change`` for regions only one of the stores has."""
    a, b = old.select("region").distinct(), new.select("region").distinct()
    added = b.subtract(a).withColumn("change", F.lit("added"))
    return added.unionByName(a.subtract(b).withColumn("change", F.lit("removed")))
