"""Statistics over a part of every year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import CELL
from ..functions import axis, calendar, numeric

# Names of the statistics and the aggregates behind them.
STATISTICS = {
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "std": F.stddev_pop,
    "median": F.median,
    "sum": F.sum,
}


def select_time_filter(df: DataFrame, time_filter: str, period_range: str = "all") -> DataFrame:
    """Rows inside ``mm-mm`` of every year, with ``season_year``.

    A filter that crosses the year end counts to the year it ends in, so it takes
    its first months from the year before. The first such season may be partial and
    is kept. ``period_range`` is ``yyyy-yyyy`` or ``all``.
    """
    first_month, last_month = (int(m) for m in time_filter.split("-"))
    year, month = F.year("time"), F.month("time")
    crosses = first_month > last_month
    season_year = F.when(month >= first_month, year + 1).otherwise(year) if crosses else year
    if period_range == "all":
        first = axis.scalar(df, F.year(F.min("time")))
        last = axis.scalar(df, F.year(F.max("time")))
    else:
        first, last = (F.lit(int(y)) for y in period_range.split("-"))
    return (
        df.withColumn("season_year", season_year)
        .where(calendar.month_in(month, first_month, last_month))
        .where(F.col("season_year").between(first, last))
    )


def seasonal_statistic(
    df: DataFrame,
    variable: str,
    statistic: str,
    time_filter: str,
    product: str,
    period_range: str = "all",
    keys: tuple[str, ...] = CELL,
) -> DataFrame:
    """One statistic per year and cell, as a series or averaged over the years.

    A missing value makes its year missing; missing years are left out of the
    climatology.
    """
    if product not in ("climatology", "temporal_series"):
        raise NotImplementedError(f"product {product!r}")
    rows = select_time_filter(df, time_filter, period_range)
    value = F.col(variable)
    yearly = rows.groupBy(*keys, "season_year").agg(
        numeric.complete_only(STATISTICS[statistic](value), value).alias(variable)
    )
    if product == "climatology":
        return yearly.groupBy(*keys).agg(F.avg(variable).alias(variable))
    label = F.make_date(F.col("season_year"), F.lit(1), F.lit(1))
    return yearly.select(*keys, label.alias("time"), variable)
