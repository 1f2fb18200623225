"""Reference percentiles per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import CELL
from ..functions import axis, calendar, numeric
from ..model import PercentileSpec, compare


def regular_percentile(history: DataFrame, variable: str, percent: float, freq: str) -> DataFrame:
    """``lat, lon, period, q``: linear percentile per cell and month, season or year."""
    return history.groupBy(*CELL, calendar.period_key(F.col("time"), freq).alias("period")).agg(
        F.percentile(variable, F.lit(percent / 100)).alias("q")
    )


def by_cell(df: DataFrame, variable: str) -> DataFrame:
    """``time, lat, lon, <variable>, cell``, partitioned by cell.

    One cell has one value per day, so no partition key is larger than the calendar.
    Sorting windows costs far more than moving rows, so the exchange keeps the session's number
    of partitions and is not merged by its bytes. The filter is one a join on the cell adds
    to one of its sides anyway; with it on both, the observations and the history of
    the same grid share one exchange.
    """
    cell = axis.cell_id(F.col("lat"), F.col("lon")).alias("cell")
    placed = df.select("time", *CELL, F.col(variable).cast("double").alias(variable), cell)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.where(F.col("cell").isNotNull()).repartition(tasks, "cell")


WINDOW = 6  # days of a moving window unless another number is asked for


def sides(window: int) -> tuple[int, int]:
    """Days before and after the day in question; of an even window the longer side lies before."""
    return window // 2, window - 1 - window // 2


def served_by_all(history: DataFrame, window: int = WINDOW) -> tuple[Column, Column]:
    """First and last day that a row's value serves: its window, inside the time axis."""
    before, after = sides(window)
    first, last = axis.scalar(history, F.min("time")), axis.scalar(history, F.max("time"))
    return F.greatest(F.date_add("time", -after), first), F.least(F.date_add("time", before), last)


def day_values(history: DataFrame, variable: str, served: tuple[Column, Column], window: int = WINDOW) -> DataFrame:
    """``cell, lat, lon, doy, own, single``: present values per cell and day of year.

    ``own`` are values of the day itself that serve all neighbours of the same year. Near the turn of a
    year, where neighbours are another year's, and where ``served`` cuts a window short, a
    value is ``single`` under each day that it serves. So rows stay as they are but for
    a few days a year.
    """
    before, after = sides(window)
    doy = F.dayofyear("time")
    whole = (F.date_add("time", -after) == F.col("low")) & (F.date_add("time", before) == F.col("high"))
    inner = (doy > after) & (doy <= 365 - before) & whole
    serves = F.when(inner, F.array(F.struct(doy.alias("doy"), F.lit(True).alias("own")))).when(
        F.col("low") <= F.col("high"),
        F.transform(F.sequence("low", "high"), lambda d: F.struct(F.dayofyear(d).alias("doy"), F.lit(False).alias("own"))),
    )
    value = F.col(variable)
    return (
        by_cell(history, variable)
        .withColumns({"low": served[0], "high": served[1]})
        .select("cell", *CELL, value, F.inline(serves))
        .groupBy("cell", "doy")
        .agg(
            F.first("lat").alias("lat"),
            F.first("lon").alias("lon"),
            # Missing values are not collected.
            F.collect_list(F.when(F.col("own"), value)).alias("own"),
            F.collect_list(F.when(~F.col("own"), value)).alias("single"),
        )
    )


def windows_of(values: DataFrame, window: int = WINDOW) -> DataFrame:
    """``cell, lat, lon, windows`` from :func:`day_values`: neighbouring arrays put together."""
    before, after = sides(window)
    entry = F.struct("doy", F.struct("own", "single"))
    year = F.sequence(F.lit(1), F.lit(366))
    held = (
        values.groupBy("cell")
        .agg(F.first("lat").alias("lat"), F.first("lon").alias("lon"), F.map_from_entries(F.collect_list(entry)).alias("m"))
        .select("cell", *CELL, F.transform(year, lambda d: F.try_element_at("m", d)).alias("days"))
    )
    none = F.array().cast("array<double>")

    def around(day: Column) -> Column:
        start = F.greatest(day - before, F.lit(1))
        near = F.slice("days", start, F.least(day + after, F.lit(366)) - start + 1)
        own = F.flatten(F.transform(near, lambda d: F.coalesce(d["own"], none)))
        return F.sort_array(F.concat(own, F.coalesce(F.try_element_at("days", day)["single"], none)))

    return held.select("cell", *CELL, F.transform(year, around).alias("windows"))


def day_windows(history: DataFrame, variable: str, window: int = WINDOW) -> DataFrame:
    """``cell, lat, lon, windows``: per cell 366 sorted arrays, the present values around each day of year.

    All years are pooled. A day outside the time axis has no window, and a window has no day outside it.
    """
    return windows_of(day_values(history, variable, served_by_all(history, window), window), window)


def day_of_year_table(
    history: DataFrame,
    variable: str,
    percent: float,
    window: int = WINDOW,
    doy_adjust: str = "interp366",
) -> DataFrame:
    """``cell, lat, lon, qs``: per cell an array of 366 percentiles, one per day of year.

    Each is taken over a moving day window with all years pooled. Rows are partitioned by
    cell once; both groupings stay inside that partitioning.

    ``doy_adjust="interp366"`` stretches days 1..365 over 1..366 when the axis has
    a 366th day; ``"none"`` keeps the raw value of day 366.
    """
    if doy_adjust not in ("interp366", "none"):
        raise ValueError(f"unknown doy_adjust {doy_adjust!r}")
    longest = axis.scalar(history, F.max(F.dayofyear("time"))) if doy_adjust == "interp366" else None
    return table_of(day_windows(history, variable, window), percent, longest)


def table_of(windows: DataFrame, percent: float, longest: Column | None) -> DataFrame:
    """``cell, lat, lon, qs`` from windows; stretched where the ``longest`` year has a 366th day."""
    quantiles = F.transform("windows", lambda vs: numeric.plotting_quantile(vs, percent / 100))
    # Kept out of later filters and lambdas, into which the optimiser would copy it.
    raw = windows.select("cell", *CELL, F.explode_outer(F.array(quantiles)).alias("qs"))
    if longest is None:
        return raw
    return raw.withColumn("qs", F.when(longest == 366, _stretched(F.col("qs"))).otherwise(F.col("qs")))


def _stretched(qs: Column) -> Column:
    """Linear interpolation of days 1..365 placed evenly over 1..366.

    Day t lies between source days t-1 and t with weights (t-1)/365 and
    (366-t)/365; the first and the last day keep their source value.
    """

    def mixed(t: Column) -> Column:
        left = F.try_element_at(qs, F.greatest(t - 1, F.lit(1)))
        right = F.try_element_at(qs, F.least(t, F.lit(365)))
        between = left * (t - 1) / 365 + right * (366 - t) / 365
        return F.when((t == 1) | (t == 366), F.when(t == 1, right).otherwise(left)).otherwise(between)

    return F.transform(F.sequence(F.lit(1), F.lit(366)), mixed)


def day_of_year_percentile(
    history: DataFrame,
    variable: str,
    percent: float,
    window: int = WINDOW,
    doy_adjust: str = "interp366",
) -> DataFrame:
    """The same table as rows ``lat, lon, doy, q``."""
    table = day_of_year_table(history, variable, percent, window, doy_adjust)
    rows = table.select(*CELL, F.posexplode_outer("qs").alias("position", "q"))
    return rows.where(F.col("q").isNotNull()).select(
        *CELL, (F.col("position") + 1).alias("doy"), "q"
    )


def reference_percentile(
    history: DataFrame, variable: str, spec: PercentileSpec, freq: str
) -> DataFrame:
    """The percentile an index asks for, over its reference span.

    Values failing the mask are left out. The comparison of the mask is the one of
    the percentile, not the one the mask carries.
    """
    rows = masked(history.where(spec.span.contains(F.col("time"))), variable, spec)
    if spec.kind == "regular":
        return regular_percentile(rows, variable, spec.value, freq)
    if spec.kind == "doy":
        return day_of_year_table(rows, variable, spec.value, spec.window)
    raise NotImplementedError(f"percentile kind {spec.kind!r}")


def masked(history: DataFrame, variable: str, spec: PercentileSpec) -> DataFrame:
    """``time, lat, lon, <variable>``; values that fail the mask are missing."""
    rows = history.select("time", *CELL, variable)
    if spec.mask is None:
        return rows
    kept = compare(F.col(variable), spec.op, float(spec.mask.value))
    return rows.withColumn(variable, F.when(kept, F.col(variable)))


def join_period_percentile(df: DataFrame, q: DataFrame, freq: str) -> DataFrame:
    """Each row with the percentile of its month, season or year as ``q``."""
    keyed = df.withColumn("period", calendar.period_key(F.col("time"), freq))
    return keyed.join(q, [*CELL, "period"], "left").drop("period")


def join_doy_percentile(df: DataFrame, table: DataFrame, variable: str) -> DataFrame:
    """``time, lat, lon, <variable>, cell, q``: each row with the percentile of its day.

    Both sides are partitioned by cell already, so the join moves nothing.
    """
    joined = by_cell(df, variable).join(table.select("cell", "qs"), "cell", "left")
    q = F.try_element_at("qs", F.dayofyear("time"))
    return joined.select("time", *CELL, variable, "cell", q.alias("q"))
