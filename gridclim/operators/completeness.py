"""Which periods hold enough samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import CELL
from ..functions import axis, calendar
from ..model import ANNUAL, DAILY, MONTHLY, SEASONAL


def frequency_of(df: DataFrame) -> DataFrame:
    """``freq, steps, first, last`` of a time axis, ``irregular`` when none fits.

    With distinct labels, the count, the ends and the position of every label in
    its period settle the frequency, so no ordering of the axis is needed.
    """
    a = axis.time_axis(df)
    months = F.year("time") * 12 + F.month("time")
    stats = a.agg(
        F.count("*").alias("steps"),
        F.min("time").alias("first"),
        F.max("time").alias("last"),
        F.max(F.dayofmonth("time")).alias("late_day"),
        F.count_distinct(months).alias("n_months"),
        F.min(months).alias("m0"),
        F.max(months).alias("m1"),
        F.max(F.month("time")).alias("hi_month"),
        F.min(F.month("time")).alias("lo_month"),
        F.count_distinct(F.month("time") % 3).alias("phases"),
        F.max(F.month("time") % 3).alias("phase"),
    )
    span = F.col("m1") - F.col("m0")
    gaps = F.col("steps") - 1
    starts = F.col("late_day") == 1
    freq = (
        F.when(F.col("steps") < 3, "irregular")
        .when(F.datediff("last", "first") == gaps, DAILY)
        .when(starts & (span == gaps), MONTHLY)
        .when(starts & (F.col("phases") == 1) & (F.col("phase") == 0) & (span == 3 * gaps), SEASONAL)
        .when(starts & (F.col("hi_month") == 1) & (F.col("lo_month") == 1) & (span == 12 * gaps), ANNUAL)
        .otherwise("irregular")
    )
    return stats.select(freq.alias("freq"), "steps", "first", "last")


def require_frequency(df: DataFrame) -> str:
    """The frequency, or an error. Runs one small aggregate."""
    row = frequency_of(df).first()
    if row["freq"] == "irregular":
        raise ValueError("the time axis is irregular, its frequency cannot be inferred")
    return row["freq"]


def period_counts(df: DataFrame, freqs: tuple[str, ...], sample: str = DAILY) -> DataFrame:
    """``freq, time, n, expected`` of the time axis, for several frequencies at once."""
    starts = F.array(
        *[
            F.struct(F.lit(f).alias("freq"), calendar.period_start(F.col("time"), f).alias("start"))
            for f in freqs
        ]
    )
    counts = (
        axis.time_axis(df)
        .select(F.explode(starts).alias("p"))
        .groupBy(F.col("p.freq").alias("freq"), F.col("p.start").alias("time"))
        .agg(F.count("*").alias("n"))
    )
    # One row per frequency.
    return counts.join(F.broadcast(calendar.expected_counts(df.sparkSession, sample)), "freq")


def complete_periods(
    df: DataFrame, freqs: tuple[str, ...], valid_fraction: float = 0.8, sample: str = DAILY
) -> DataFrame:
    """``freq, time`` of the periods with enough time labels; missing values count.

    Judged on the time axis, which all cells share.
    """
    _check_fraction(valid_fraction)
    return (
        period_counts(df, freqs, sample)
        .where(F.col("n") >= F.col("expected") * F.lit(valid_fraction))
        .select("freq", "time")
    )


def complete_cell_periods(
    df: DataFrame, variable: str, freq: str, valid_fraction: float = 0.8, sample: str = DAILY
) -> DataFrame:
    """Cell periods with enough present values (missing values do not count)."""
    _check_fraction(valid_fraction)
    counts = df.groupBy(*CELL, calendar.period_start(F.col("time"), freq).alias("time")).agg(
        F.count(variable).alias("n")
    )
    expected = calendar.expected_counts(df.sparkSession, sample).where(F.col("freq") == freq)
    needed = expected.select((F.col("expected") * F.lit(valid_fraction)).alias("needed")).scalar()
    return counts.where(F.col("n") >= needed).select(*CELL, "time")


def keep_complete(index: DataFrame, periods: DataFrame, freq: str | None = None) -> DataFrame:
    """Index rows of complete periods.

    The list of periods is bounded by the calendar (17 per year), so it is
    broadcast and the index is not shuffled.
    """
    if freq is not None:
        periods = periods.where(F.col("freq") == freq).select("time")
        return index.join(F.broadcast(periods), "time", "left_semi")
    return index.join(F.broadcast(periods), ["freq", "time"], "left_semi")


def _check_fraction(valid_fraction: float) -> None:
    if not 0 <= valid_fraction <= 1:
        raise ValueError("valid_fraction must be between 0 and 1")


def reference_rows(df: DataFrame, inside: Column) -> DataFrame:
    """Rows of the reference span; an empty span is an error."""
    rows = df.where(inside)
    if rows.isEmpty():
        raise ValueError("the reference span lies outside the data")
    return rows
