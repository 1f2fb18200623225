"""Period arithmetic on DATE columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import registries
from ..model import ALL_FREQS, ANNUAL, DAILY, MONTHLY, SEASONAL, STANDARD_FREQS, WEEKLY, WEEKLY_MONDAY
from ..session import small_table


def period_start(time: Column, freq: str) -> Column:
    """First day of the period ``time`` falls in.

    Seasons start in December, March, June and September; weeks on Monday.
    """
    if freq == MONTHLY:
        start = F.date_trunc("month", time)
    elif freq == SEASONAL:
        # One month ahead, seasons are calendar quarters.
        start = F.add_months(F.date_trunc("quarter", F.add_months(time, 1)), -1)
    elif freq == ANNUAL:
        start = F.date_trunc("year", time)
    elif freq in (WEEKLY, WEEKLY_MONDAY):
        start = F.date_trunc("week", time)
    elif freq == DAILY:
        start = time
    else:
        raise ValueError(f"unknown frequency {freq!r}")
    return F.to_date(start)


def component(freq: str) -> str:
    """The part of a date that groups one frequency across years."""
    parts = {ANNUAL: "year", SEASONAL: "season", MONTHLY: "month"}
    if freq not in parts:
        raise NotImplementedError(f"no calendar component for {freq!r}")
    return parts[freq]


def period_key(time: Column, freq: str) -> Column:
    """Month name or season name; one constant for annual."""
    part = component(freq)
    if part == "year":
        return F.lit("Annual")
    return range_name(F.month(time), SEASON_RANGES if part == "season" else MONTH_RANGES)


def _ranges(names: list[str]) -> list[tuple[str, int, int]]:
    bounds = registries.TIME_FILTERS
    return [(n, int(bounds[n][:2]), int(bounds[n][3:])) for n in names]


SEASON_RANGES = _ranges(["DecFeb", "MarMay", "JunAug", "SepNov"])
MONTH_RANGES = _ranges(
    ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
)


def month_in(month: Column, first: int, last: int) -> Column:
    """Whether a month lies in a range that may cross the year end."""
    if first <= last:
        return month.between(first, last)
    return (month >= first) | (month <= last)


def range_name(month: Column, ranges: list[tuple[str, int, int]]) -> Column:
    """Name of the first range holding the month; a month outside all is an error."""
    named = F.coalesce(*[F.when(month_in(month, lo, hi), F.lit(n)) for n, lo, hi in ranges])
    failed = F.raise_error(F.concat(F.lit("no range holds month "), month.cast("string")))
    return F.when(month.isNull(), F.lit(None)).otherwise(F.coalesce(named, failed.cast("string")))


def filter_name(start: Column, freq: str) -> Column:
    """``time_filter`` label of a period start."""
    return period_key(start, freq)


def time_reference(start: Column, freq: str) -> Column:
    """Date a period is stored under: a December season belongs to the next January."""
    if freq not in STANDARD_FREQS:
        raise ValueError(f"unsupported frequency {freq!r}")
    if freq != SEASONAL:
        return start
    return F.when(F.month(start) == 12, F.make_date(F.year(start) + 1, F.lit(1), F.lit(1))).otherwise(
        start
    )


def reverse_time_reference(reference: Column, freq: str) -> Column:
    """Period start behind a stored reference date."""
    if freq not in STANDARD_FREQS:
        raise ValueError(f"unsupported frequency {freq!r}")
    if freq != SEASONAL:
        return reference
    return F.when(
        F.month(reference) == 1, F.make_date(F.year(reference) - 1, F.lit(12), F.lit(1))
    ).otherwise(reference)


def freq_of_filter(time_filter: Column) -> Column:
    """Frequency a ``time_filter`` label belongs to."""
    seasons = [n for n, _, _ in SEASON_RANGES]
    return (
        F.when(time_filter == "Annual", ANNUAL)
        .when(time_filter.isin(seasons), SEASONAL)
        .otherwise(MONTHLY)
    )


def expected_counts(spark: SparkSession, sample: str = DAILY) -> DataFrame:
    """``freq, expected``: usual number of samples per period over ten years from 2000."""
    step = {DAILY: "INTERVAL 1 DAY", MONTHLY: "INTERVAL 1 MONTH"}.get(sample)
    if step is None:
        raise ValueError(f"no expected counts for samples at {sample!r}")
    axis = small_table(spark, [("2000-01-01", "2010-01-01")], "a string, b string").select(
        F.explode(F.sequence(F.to_date("a"), F.to_date("b"), F.expr(step))).alias("time")
    )
    starts = axis.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(f).alias("freq"), period_start(F.col("time"), f).alias("start"))
                    for f in (ALL_FREQS if sample == DAILY else STANDARD_FREQS)
                ]
            )
        ).alias("p")
    )
    counts = starts.groupBy("p.freq", "p.start").agg(F.count("*").alias("n"))
    return counts.groupBy("freq").agg(F.mode("n").alias("expected"))


def default_end(today: Column) -> Column:
    """Last day of the month before ``today``."""
    return F.last_day(F.add_months(today, -1))
