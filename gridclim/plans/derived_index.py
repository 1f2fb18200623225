"""From daily cells to regional indices."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import CELL
from ..model import STANDARD_FREQS
from ..operators import combine, completeness, indices, regions
from .reference import Reference

LABELS = ("index", "time", "time_filter", "period")


def _complete_frames(
    grid: DataFrame,
    names: tuple[str, ...],
    freqs: tuple[str, ...],
    history: DataFrame | None,
    valid_fraction: float,
    axis_of: DataFrame | None,
    reference: Reference | None = None,
    months: set[int] | None = None,
) -> list[tuple[DataFrame, tuple[str, ...]]]:
    """Wide frames ``lat, lon, freq, time, <index columns>`` of complete periods."""
    for name in names:
        indices.validate_freqs(indices.get_index(name).index, freqs)
    counts = tuple(n for n in names if n in indices.COUNT_INDICES)
    ever = None if reference is None else reference.presence()
    frames = [(indices.count_indices_wide(grid, counts, freqs, history, ever), counts)] if counts else []
    for n in names:
        if n not in counts:
            q = None if reference is None else reference.percentiles(n, months)
            frames.append((indices.precipitation_shares(grid, freqs, history, n, q), (n,)))
    source = grid if axis_of is None else axis_of
    complete = completeness.complete_periods(source, freqs, valid_fraction)
    return [(completeness.keep_complete(df, complete), cols) for df, cols in frames]


def cell_indices(
    grid: DataFrame,
    names: tuple[str, ...],
    freqs: tuple[str, ...] = STANDARD_FREQS,
    history: DataFrame | None = None,
    valid_fraction: float = 0.8,
    axis_of: DataFrame | None = None,
) -> DataFrame:
    """``lat, lon, index, time, time_filter, period, value`` of complete periods.

    ``history`` is what percentiles refer to and what decides whether a cell has values
    at all, and ``axis_of`` what completeness is judged on; both default to the grid.
    """
    frames = _complete_frames(grid, names, freqs, history, valid_fraction, axis_of)
    long = reduce(DataFrame.unionByName, [indices.to_long(df, cols) for df, cols in frames])
    return combine.label_rolled(long).select(*CELL, *LABELS, "value")


def regional_indices(
    grid: DataFrame,
    xwalk: DataFrame,
    names: tuple[str, ...],
    freqs: tuple[str, ...] = STANDARD_FREQS,
    history: DataFrame | None = None,
    valid_fraction: float = 0.8,
    axis_of: DataFrame | None = None,
    due: dict[str, dt.date] | None = None,
    reference: Reference | None = None,
    months: set[int] | None = None,
) -> DataFrame:
    """Mean of the cell indices per region; indices come first, regions second.

    Cells meet regions with all indices side by side, so a cell-period is sent to
    each of its regions once, and labels are made after the rows have become few.
    ``due`` keeps, per frequency, periods from a date on. ``reference`` is the state kept
    beside the grid, in place of a history; the days of the grid then lie in ``months``.
    """
    frames = _complete_frames(grid, names, freqs, history, valid_fraction, axis_of, reference, months)
    if due is not None:
        wanted = reduce(
            lambda a, b: a | b,
            [(F.col("freq") == f) & (F.col("time") >= F.lit(first)) for f, first in due.items()],
        )
        frames = [(df.where(wanted), cols) for df, cols in frames]
    means = [
        indices.to_long(
            regions.aggregate_regions(df, xwalk, list(cols), ("freq", "time"), scattered=True), cols
        )
        for df, cols in frames
    ]
    labelled = combine.label_rolled(reduce(DataFrame.unionByName, means))
    return labelled.select("region_set", "region", *LABELS, "value")


def to_sink(regional: DataFrame) -> DataFrame:
    """The stored form: values as FLOAT."""
    return regional.withColumn("value", F.col("value").cast("float"))
