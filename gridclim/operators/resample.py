"""Aggregation of daily rows to periods."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import CELL
from ..functions import axis, calendar, numeric
from ..model import ANNUAL, DAILY, MONTHLY, SEASONAL, WEEKLY_MONDAY

# Present samples a period needs, by sample and target frequency.
MINIMUM_SAMPLES = {
    DAILY: {MONTHLY: 25, SEASONAL: 75, ANNUAL: 350, WEEKLY_MONDAY: 1},
    MONTHLY: {MONTHLY: 1, SEASONAL: 3, ANNUAL: 12},
}


def minimum_samples(freq: str, sample: str = DAILY) -> int:
    try:
        return MINIMUM_SAMPLES[sample][freq]
    except KeyError:
        raise ValueError(f"no minimum is defined for {sample} samples at {freq}") from None


def guarded(
    reducer: Callable[[Column], Column], freq: str, sample: str = DAILY
) -> Callable[[Column], Column]:
    """A reducer whose result is missing when the period has too few present values."""
    minimum = minimum_samples(freq, sample)
    return lambda value: numeric.at_least(reducer(value), value, minimum)


def resample(
    df: DataFrame, freq: str, aggregates: Mapping[str, Column], keys: tuple[str, ...] = CELL
) -> DataFrame:
    """One row per key and period, stored under the first day of the period."""
    return df.groupBy(*keys, calendar.period_start(F.col("time"), freq).alias("time")).agg(
        *[c.alias(n) for n, c in aggregates.items()]
    )


def resample_cells(df: DataFrame, freq: str, aggregates: Mapping[str, Column]) -> DataFrame:
    """``resample`` for rows that are partitioned by ``cell``; nothing is exchanged."""
    place = {c: F.first(c) for c in CELL}
    return resample(df, freq, {**place, **aggregates}, ("cell",))


def roll_up(monthly: DataFrame, freqs: tuple[str, ...], sums: tuple[str, ...]) -> DataFrame:
    """Additive monthly columns to several frequencies in one pass.

    Daily data is aggregated once; each monthly row then goes to one period per
    frequency. Rows are partitioned by ``cell``, by one exchange where they are not
    yet, and stay so. Adds ``freq``.
    """
    targets = F.array(
        *[
            F.struct(F.lit(f).alias("freq"), calendar.period_start(F.col("time"), f).alias("start"))
            for f in freqs
        ]
    )
    if "cell" not in monthly.columns:
        cell = axis.cell_id(F.col("lat"), F.col("lon"))
        monthly = monthly.withColumn("cell", cell).repartition("cell")
    return (
        monthly.select("cell", *CELL, F.explode(targets).alias("_t"), *sums)
        .groupBy("cell", F.col("_t.freq").alias("freq"), F.col("_t.start").alias("time"))
        .agg(*[F.first(c).alias(c) for c in CELL], *[F.sum(s).alias(s) for s in sums])
    )


def lift(fn: Callable[[Column], Column], variable: str, name: str | None = None):
    """A function of columns as a function of frames."""

    def on_frame(df: DataFrame) -> DataFrame:
        return df.withColumn(name or variable, fn(F.col(variable)))

    return on_frame


DAILY_STATISTICS = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum}

# Statistic that makes a daily value of each variable.
VARIABLE_STATISTIC = {"tas": "mean", "tasmax": "max", "tasmin": "min", "pr": "sum", "sfcWind": "mean"}


def variable_statistic(value: Column) -> Column:
    """The daily statistic that fits ``variable``, for a long frame grouped by it."""
    out = F.lit(None).cast("double")
    for variable, stat in VARIABLE_STATISTIC.items():
        out = F.when(F.col("variable") == variable, DAILY_STATISTICS[stat](value)).otherwise(out)
    return out


def daily_statistics(df: DataFrame, keys: tuple[str, ...] = CELL) -> DataFrame:
    """Sub-daily ``(ts, variable, value)`` rows to one value per variable and day."""
    return (
        df.groupBy(*keys, "variable", F.to_date("ts").alias("time"))
        .agg(variable_statistic(F.col("value")).alias("value"), F.count("value").alias("n"))
    )
