"""One table for all frequencies of an index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import CELL
from ..functions import calendar
from ..model import STANDARD_FREQS
from ..registries import TIME_FILTERS


def label_periods(df: DataFrame, freq: str) -> DataFrame:
    """Adds ``time_filter`` and moves ``time`` to the reference date; keeps ``period``."""
    start = F.col("time")
    return df.withColumns(
        {
            "period": start,
            "time_filter": calendar.filter_name(start, freq),
            "time": calendar.time_reference(start, freq),
        }
    )


def combine(frames: dict[str, DataFrame]) -> DataFrame:
    """Union of labelled frames. Other than the standard frequencies are left out.

    Rows stay sparse: a (time, time_filter) pair that no frequency produces is absent.
    """
    labelled = [label_periods(frames[f], f) for f in STANDARD_FREQS if f in frames]
    if not labelled:
        raise ValueError("nothing to combine")
    return reduce(DataFrame.unionByName, labelled)


def label_rolled(df: DataFrame) -> DataFrame:
    """The same for a frame that carries ``freq``."""
    start, freq = F.col("time"), F.col("freq")

    def by_freq(fn) -> Column:
        out = F.lit(None)
        for f in STANDARD_FREQS:
            out = F.when(freq == f, fn(start, f)).otherwise(out)
        return out

    return df.withColumns(
        {
            "period": start,
            "time_filter": by_freq(calendar.filter_name),
            "time": by_freq(calendar.time_reference),
        }
    )


def checkpoints(combined: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``freq, last_period``: latest period start per frequency (and key)."""
    freq = calendar.freq_of_filter(F.col("time_filter")).alias("freq")
    return combined.groupBy(*keys, freq).agg(F.max("period").alias("last_period"))


def checkpoint_attributes(points: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One ``attrs`` map per key: ``last_checkpoint_*`` and ``frequencies_used``."""
    order = F.array(*[F.lit(f) for f in STANDARD_FREQS])
    entry = F.struct(
        F.concat(F.lit("last_checkpoint_"), "freq"),
        F.date_format("last_period", "yyyy-MM-dd'T'HH:mm:ss"),
    )
    used = F.array_join(F.filter(order, lambda f: F.array_contains(F.collect_set("freq"), f)), ", ")
    # At most one entry per frequency.
    return points.groupBy(*keys).agg(
        F.map_concat(
            F.map_from_entries(F.collect_list(entry)), F.create_map(F.lit("frequencies_used"), used)
        ).alias("attrs")
    )


def valid_filters() -> list[str]:
    """All labels: months, seasons, annual."""
    names = list(TIME_FILTERS)
    return names[5:] + names[1:5] + names[:1]


def by_cell(df: DataFrame) -> DataFrame:
    return df.select(*CELL, "time_filter", "time", "value")
