"""Sub-daily observations as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import CELL
from ..operators.resample import variable_statistic
from ..sources import store


def daily_statistics_stream(observations: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Daily value per cell and variable from ``ts, lat, lon, variable, value``.

    A day is emitted once no observation within ``lateness`` of the newest can still
    reach it; later ones are dropped. State is one row per open day, cell and variable.
    """
    return (
        observations.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", lateness)
        .groupBy(*CELL, "variable", F.window("ts", "1 day").alias("day"))
        .agg(variable_statistic(F.col("value")).alias("value"), F.count("value").alias("n"))
        .select(*CELL, "variable", F.to_date("day.start").alias("time"), "value", "n")
    )


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, append finished days to a Parquet folder, then stop."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_available(
    stream: DataFrame, path: str, checkpoint: str, key: Sequence[str]
) -> StreamingQuery:
    """Upsert each micro-batch of grid rows into a store.

    A batch replayed after a failure rewrites the same keys, so the store ends the same.
    Of several rows with one key the largest in the order of the other columns stays.
    """

    def apply(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        others = F.struct(*[c for c in batch.columns if c not in key])
        latest = store.clean(batch).groupBy(*key).agg(F.max(others).alias("_row")).select(*key, "_row.*")
        if store.exists(spark, path):
            store.update_store(spark, path, latest, key)
        else:
            store.write_store(store.with_year(latest), path, partition_by=["year"])

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
