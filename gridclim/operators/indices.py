"""Climate indices: definitions, hooks and the driver that runs them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import CELL
from ..functions import axis
from ..model import (
    DAILY,
    MONTHLY,
    NEEDS_HISTORY,
    NEEDS_INPUT,
    NEEDS_PERCENTILE,
    STANDARD_FREQS,
    WEEKLY,
    WEEKLY_MONDAY,
    IndexConfig,
    IndexContext,
    IndexDef,
    PercentileSpec,
    Threshold,
    compare,
)
from ..session import small_table
from . import percentiles, resample
from .units import check_inputs


def count_days(df: DataFrame, context: IndexContext) -> DataFrame:
    """Days per cell and period that pass ``options["test"]``."""
    value = F.col(context.variable)
    test: Threshold = context.options["test"]
    return resample.resample(
        df,
        context.freq,
        {
            context.variable: F.count_if(test.holds(value)).cast("double"),
            "n_valid": F.count(value),
        },
    )


def _share_parts(joined: DataFrame, variable: str, wet: float) -> dict[str, Column]:
    """Total of the days above their percentile, and of the wet days."""
    value = F.col(variable)
    extreme = (value > F.col("q")) & (value > wet)
    return {
        "over": F.coalesce(F.sum(F.when(extreme, value)), F.lit(0.0)),
        "total": F.coalesce(F.sum(F.when(value > wet, value)), F.lit(0.0)),
        "n_valid": F.count(value),
    }


def share_above_percentile(df: DataFrame, context: IndexContext) -> DataFrame:
    """Share of the wet-day total that falls on days above their percentile."""
    variable = context.variable
    joined = percentiles.join_doy_percentile(df, context.percentile, variable)
    parts = _share_parts(joined, variable, float(context.options["wet"]))
    out = resample.resample_cells(joined, context.freq, parts)
    return out.withColumn(variable, F.try_divide("over", "total")).drop("over", "total")


# Thresholds of one day's temperature also make sense over weeks and days.
SHORT_FREQS = (WEEKLY_MONDAY, WEEKLY, DAILY)


def _day_count(name: str, variable: str, value: float, op: str, title: str | None = None) -> IndexDef:
    return IndexDef(
        name=name,
        title=title or name,
        units="days",
        inputs=(variable,),
        direct=count_days,
        needs=NEEDS_INPUT,
        options={"test": Threshold(value, op)},
        threshold=Threshold(value, op),
        more_freqs=SHORT_FREQS if name == "fd" or name.startswith("tx") else (),
    )


# Index thresholds and descriptions.
AVAILABLE = {
    "tx30": IndexConfig(
        _day_count("tx30", "tasmax", 30, "gt"),
        "Number of days with maximum temperature above 30°C",
    ),
    "tx35": IndexConfig(
        _day_count("tx35", "tasmax", 35, "gt"),
        "Number of days with maximum temperature above 35°C",
    ),
    "tx40": IndexConfig(
        _day_count("tx40", "tasmax", 40, "gt"),
        "Number of days with maximum temperature above 40°C",
    ),
    "tr20": IndexConfig(
        _day_count("tr20", "tasmin", 20, "gt"),
        "Number of tropical nights with minimum temperature above 20°C",
    ),
    "tr25": IndexConfig(
        _day_count("tr25", "tasmin", 25, "gt"),
        "Number of equatorial nights with minimum temperature above 25°C",
    ),
    "fd": IndexConfig(
        _day_count("fd", "tasmin", 0, "lt", "Frost days"),
        "Number of frost days with minimum temperature below 0°C",
    ),
    "r20mm": IndexConfig(
        _day_count("r20mm", "pr", 20, "ge"),
        "Number of days with precipitation above 20mm",
    ),
    "r1mm": IndexConfig(
        _day_count("r1mm", "pr", 1, "ge"),
        "Number of wet days with precipitation above 1mm",
    ),
    "r95ptot": IndexConfig(
        IndexDef(
            name="r95ptot",
            title="r95ptot",
            units="1",
            inputs=("pr",),
            direct=share_above_percentile,
            needs=NEEDS_PERCENTILE,
            options={"wet": 1.0},
            percentile=PercentileSpec(95, kind="doy", op="gt"),
        ),
        "Fraction of total precipitation from days above 95th percentile",
    ),
}

COUNT_INDICES = tuple(n for n, c in AVAILABLE.items() if c.index.direct is count_days)


def get_index(name: str) -> IndexConfig:
    if name not in AVAILABLE:
        raise KeyError(f"unknown index {name!r}; available: {list_indices()}")
    return AVAILABLE[name]


def list_indices() -> list[str]:
    return sorted(AVAILABLE)


def index_table(spark: SparkSession) -> DataFrame:
    """``index, title, units, variable, description, freqs``."""
    rows = [
        (n, c.index.title, c.index.units, c.index.variable, c.description, ", ".join(c.freqs))
        for n, c in AVAILABLE.items()
    ]
    return small_table(
        spark,
        rows,
        "index string, title string, units string, variable string, description string, freqs string",
    )


def validate_freqs(index: IndexDef, freqs: tuple[str, ...] | list[str] | str | None) -> tuple[str, ...]:
    """Requested frequencies, all of them by default; an unsupported one is an error."""
    wanted = index.freqs if freqs is None else (freqs,) if isinstance(freqs, str) else tuple(freqs)
    refused = [f for f in wanted if f not in (*index.freqs, *index.more_freqs)]
    if refused:
        raise ValueError(f"{index.name} is not available at {refused}")
    return wanted


def call_direct(df: DataFrame, index: IndexDef, context: IndexContext) -> DataFrame:
    """Run a direct hook with what it declared to need."""
    if index.needs == NEEDS_PERCENTILE and context.percentile is None:
        raise ValueError(f"{index.name} needs a reference percentile")
    if index.needs not in (NEEDS_INPUT, NEEDS_HISTORY, NEEDS_PERCENTILE):
        raise ValueError(f"unknown signature {index.needs!r}")
    return index.direct(df, context)


def compute_index(
    grid: DataFrame,
    index: IndexDef,
    freq: str = MONTHLY,
    history: DataFrame | None = None,
    sample: str = DAILY,
    units: dict[str, str] | None = None,
) -> DataFrame:
    """``lat, lon, time, value`` of one index at one frequency.

    Percentiles are taken over ``history``, by default the whole grid given. A
    cell without any present input is missing at all times, not zero.
    """
    validate_freqs(index, freq)
    check_inputs(grid, index, units)
    variable = index.variable
    reference = grid if history is None else check_inputs(history, index)
    q = None
    if index.percentile is not None:
        q = percentiles.reference_percentile(reference, variable, index.percentile, freq)
    if index.direct is not None:
        context = IndexContext(variable, freq, index.options, reference, q)
        out = call_direct(grid.select("time", *CELL, *index.inputs), index, context)
    else:
        out = _reduce(grid, index, freq, q, sample)
    if "n_valid" in out.columns:
        if "cell" not in out.columns:
            out = out.withColumn("cell", axis.cell_id(F.col("lat"), F.col("lon")))
        present = F.sum("n_valid").over(Window.partitionBy("cell")) > 0
        return out.select(*CELL, "time", F.when(present, F.col(variable)).alias("value"))
    return mask_empty_cells(out.withColumnRenamed(variable, "value"), grid, variable)


def _reduce(
    grid: DataFrame, index: IndexDef, freq: str, q: DataFrame | None, sample: str
) -> DataFrame:
    """Season, then threshold or percentile test, then reducer."""
    if index.reducer is None:
        raise ValueError(f"{index.name} has neither a direct hook nor a reducer")
    variable = index.variable
    df = grid.select("time", *CELL, variable)
    if index.season is not None:
        df = df.where(index.season.contains(F.col("time")))
    value = tested = F.col(variable)
    if index.threshold is not None:
        tested = index.threshold.holds(value).cast("double")
    elif index.percentile is not None:
        if index.percentile.kind != "regular":
            raise ValueError("a day-of-year percentile needs a direct hook")
        df = percentiles.join_period_percentile(df, q, freq)
        tested = F.coalesce(compare(value, index.percentile.op, F.col("q")), F.lit(False)).cast("double")
    reducer = index.reducer
    if index.season is None:
        reducer = resample.guarded(reducer, freq, sample)
    df = df.withColumn("_tested", tested)
    columns = {variable: reducer(F.col("_tested"))}
    if index.season is None:  # else presence is judged on the whole input
        columns["n_valid"] = F.count(value)
    return resample.resample(df, freq, columns)


def mask_empty_cells(out: DataFrame, grid: DataFrame, variable: str) -> DataFrame:
    """``value`` becomes missing in cells whose input is missing at all times."""
    cells = grid.groupBy(*CELL).agg((F.count(variable) > 0).alias("present"))
    return out.join(cells, [*CELL], "left").select(
        *CELL, "time", F.when(F.col("present"), F.col("value")).alias("value")
    )


def count_expressions(names: tuple[str, ...]) -> dict[str, Column]:
    out = {}
    for name in names:
        index = get_index(name).index
        test: Threshold = index.options["test"]
        out[name] = F.count_if(test.holds(F.col(index.variable)))
    return out


def count_indices_wide(
    grid: DataFrame,
    names: tuple[str, ...] = COUNT_INDICES,
    freqs: tuple[str, ...] = STANDARD_FREQS,
    history: DataFrame | None = None,
    ever: DataFrame | None = None,
) -> DataFrame:
    """``lat, lon, freq, time`` and one column per count index, in one pass.

    The daily rows are read and shuffled once, as monthly counts; seasons and years
    are sums of those. A cell is missing if it has no value at any time: in ``grid``,
    or in ``history`` where ``grid`` is only the newest part of it. ``ever`` says so
    without reading a history, as ``cell`` and ``has_<variable>``.
    """
    variables = tuple(sorted({get_index(n).index.variable for n in names}))
    aggregates = count_expressions(names)
    valid = {f"valid_{v}": F.count(v) for v in variables}
    monthly = resample.resample(grid, MONTHLY, {**aggregates, **valid})
    rolled = resample.roll_up(monthly, freqs, (*aggregates, *valid))
    if history is None and ever is None:
        cell = Window.partitionBy("cell")
        present = {v: F.sum(f"valid_{v}").over(cell) > 0 for v in variables}
        rolled = rolled.withColumns({f"has_{v}": p for v, p in present.items()})
    else:
        cell = axis.cell_id(F.col("lat"), F.col("lon")).alias("cell")
        if ever is None:
            ever = history.groupBy(cell).agg(*[(F.count(v) > 0).alias(f"has_{v}") for v in variables])
        rolled = rolled.join(ever, "cell", "left")
    return rolled.select(
        *CELL,
        "freq",
        "time",
        *[
            F.when(F.col(f"has_{get_index(n).index.variable}"), F.col(n).cast("double")).alias(n)
            for n in names
        ],
    )


def to_long(wide: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Index columns to rows ``index, value``."""
    others = [c for c in wide.columns if c not in names]
    entries = [F.struct(F.lit(n).alias("index"), F.col(n).alias("value")) for n in names]
    return wide.select(*others, F.inline(F.array(*entries)))


def count_indices(
    grid: DataFrame,
    names: tuple[str, ...] = COUNT_INDICES,
    freqs: tuple[str, ...] = STANDARD_FREQS,
) -> DataFrame:
    """The same as ``lat, lon, freq, time, index, value``."""
    return to_long(count_indices_wide(grid, names, freqs), names)


def precipitation_shares(
    grid: DataFrame,
    freqs: tuple[str, ...] = STANDARD_FREQS,
    history: DataFrame | None = None,
    name: str = "r95ptot",
    q: DataFrame | None = None,
) -> DataFrame:
    """``lat, lon, freq, time`` and the share as a column named like the index, in one pass.

    Numerator and denominator are additive, so months are rolled up and divided last.
    ``q`` is the table of percentiles where it is known; else it is made from ``history`` or the grid.
    """
    index = get_index(name).index
    if q is None:
        reference = grid if history is None else history
        q = percentiles.reference_percentile(reference, index.variable, index.percentile, MONTHLY)
    joined = percentiles.join_doy_percentile(grid, q, index.variable)
    parts = _share_parts(joined, index.variable, float(index.options["wet"]))
    monthly = resample.resample_cells(joined, MONTHLY, parts)
    rolled = resample.roll_up(monthly, freqs, tuple(parts))
    return rolled.select(*CELL, "freq", "time", F.try_divide("over", "total").alias(name))
