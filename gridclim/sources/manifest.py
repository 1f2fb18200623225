"""Date ranges as lists of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import registries
from ..functions import text
from . import naming


def days_of(date: Column, grain: Column) -> Column:
    """Days a request lists: one, the month's, or 01..31."""
    month = F.sequence(F.lit(1), F.dayofmonth(F.last_day(date)))
    return text.padded(
        F.when(grain == "daily", F.array(F.dayofmonth(date)))
        .when(grain == "monthly", month)
        .otherwise(F.sequence(F.lit(1), F.lit(31)))
    )


def months_of(date: Column, grain: Column) -> Column:
    return text.padded(
        F.when(grain == "yearly", F.sequence(F.lit(1), F.lit(12))).otherwise(F.array(F.month(date)))
    )


def _starts(grain: Column, compat: bool) -> Column:
    """Period starts in ``[start, end]``.

    With ``compat`` a range that begins inside a month or year loses that period;
    otherwise it begins at the start of it.
    """

    def later_of(unit: str) -> Column:
        at = F.trunc("start", unit)
        step = 1 if unit == "month" else 12
        return F.when(at == F.col("start"), at).otherwise(F.add_months(at, step)) if compat else at

    def run(first: Column, step: str) -> Column:
        dates = F.sequence(F.least(first, F.col("end")), F.col("end"), F.expr(step))
        return F.filter(dates, lambda d: (d >= first) & (d <= F.col("end")))

    # sequence() keeps the day of its first date, so the ends are compared after it.
    return (
        F.when(F.col("start") > F.col("end"), F.array().cast("array<date>"))
        .when(grain == "daily", run(F.col("start"), "INTERVAL 1 DAY"))
        .when(grain == "monthly", run(later_of("month"), "INTERVAL 1 MONTH"))
        .otherwise(run(later_of("year"), "INTERVAL 1 YEAR"))
    )


def requests(
    ranges: DataFrame,
    directory: str,
    product: str = registries.DAILY_STATISTICS,
    area: tuple[float, float, float, float] | None = None,
    compat: bool = True,
) -> DataFrame:
    """One row per file to fetch for ``(variable, level, start, end, grain)`` rows.

    Carries the fields of the request and, as ``first_day`` and ``last_day``, the
    part of it the range asked for. A range makes as many rows as it has days, so ranges are
    dealt evenly to the session's number of partitions first, however few files they come from.
    """
    fields = registries.REQUEST_FIELDS[product]
    ranges = ranges.repartition(int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    names = F.broadcast(registries.request_names_table(ranges.sparkSession))  # five constants
    dated = ranges.join(names, "variable").withColumn("date", F.explode(_starts(F.col("grain"), compat)))
    grain, date = F.col("grain"), F.col("date")
    extension = F.when(F.size("request_names") > 1, "zip").otherwise("nc")
    period_end = (
        F.when(grain == "daily", date)
        .when(grain == "monthly", F.last_day(date))
        .otherwise(F.make_date(F.year(date), F.lit(12), F.lit(31)))
    )

    def field(name: str, value: Column) -> Column:
        return (value if name in fields else F.lit(None).cast("string")).alias(name)

    hours = F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":00"))), ","
    )
    return dated.select(
        naming.file_path(
            F.lit(directory), F.lit("ERA5"), F.col("variable"), F.col("level"), date, grain, extension
        ).alias("file"),
        F.lit(product).alias("product"),
        "variable",
        "grain",
        "request_names",
        F.year(date).cast("string").alias("year"),
        months_of(date, grain).alias("months"),
        days_of(date, grain).alias("days"),
        F.lit(list(map(float, area)) if area else None).cast("array<double>").alias("area"),
        field("daily_statistic", F.col("statistic")),
        field("time_zone", F.lit("utc+00:00")),
        field("frequency", F.lit("1_hourly")),
        field("pressure_level", F.col("level")),
        field("time", hours),
        field("data_format", F.lit("netcdf")),
        field("download_format", F.lit("unarchived")),
        F.greatest(date, F.col("start")).alias("first_day"),
        F.least(period_end, F.col("end")).alias("last_day"),
    )


def missing_files(manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Requests whose file is absent or not valid. ``present`` is ``file, valid``."""
    return manifest.join(present.where("valid").select("file"), "file", "left_anti")
