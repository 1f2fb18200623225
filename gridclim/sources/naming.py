"""File and store names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY, DAY_RANGE = "yyyyMMdd", "ddMMyyyy"
GRAINS = ("daily", "monthly", "yearly")


def date_token(date: Column, grain: Column) -> Column:
    """``yyyyMMdd`` for a day, ``ddMMyyyy-ddMMyyyy`` for a month or a year."""
    year = F.year(date)

    def pair(a: Column, b: Column) -> Column:
        return F.concat_ws("-", F.date_format(a, DAY_RANGE), F.date_format(b, DAY_RANGE))

    return (
        F.when(grain == "daily", F.date_format(date, DAY))
        .when(grain == "monthly", pair(F.trunc(date, "month"), F.last_day(date)))
        .when(
            grain == "yearly",
            pair(F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.lit(12), F.lit(31))),
        )
        .otherwise(F.raise_error(F.concat(F.lit("unsupported grain "), grain)).cast("string"))
    )


def file_path(
    directory: Column,
    dataset: Column,
    variable: Column,
    level: Column,
    date: Column,
    grain: Column,
    extension: Column,
) -> Column:
    """``{dir}/{dataset}/{variable}/{level}/{yyyy}/{variable}_{level}_{dataset}_{token}.{ext}``.

    Without a date there is no year folder and the token is ``None``, as is a
    missing level.
    """
    level = F.when(level.isNull() | (level == ""), "None").otherwise(level)
    token = F.when(date.isNull(), "None").otherwise(date_token(date, grain))
    name = F.concat(F.concat_ws("_", variable, level, dataset, token), F.lit("."), extension)
    return F.concat_ws("/", directory, dataset, variable, level, F.date_format(date, "yyyy"), name)


def parse_path(path: Column) -> Column:
    """The parts of such a path as a struct with an ``error`` that is NULL when it fits."""
    parts = F.split(path, "/")
    n = F.size(parts)

    def folder(back: int) -> Column:
        return F.try_element_at(parts, F.lit(-1 - back))

    name = F.split(folder(0), "_")
    dataset, variable = folder(4), folder(3)
    head = F.try_element_at(name, F.lit(1))
    file_variable = F.regexp_replace(head, "[0-9]+$", "")
    token = F.split_part(F.try_element_at(name, F.lit(4)), F.lit("."), F.lit(1))
    day = F.when(token.rlike("^[0-9]{8}$"), F.to_date(F.try_to_timestamp(token, F.lit(DAY))))

    def range_end(i: int) -> Column:
        piece = F.regexp_extract(token, "^([0-9]{8})-([0-9]{8})$", i)
        return F.when(piece != "", F.to_date(F.try_to_timestamp(piece, F.lit(DAY_RANGE))))

    first, last = range_end(1), range_end(2)
    whole_year = (F.date_format(first, "MMdd") == "0101") & (F.date_format(last, "MMdd") == "1231")
    one_month = (F.dayofmonth(first) == 1) & (F.month(first) == F.month(last))
    grain = (
        F.when(day.isNotNull(), "daily").when(whole_year, "yearly").when(one_month, "monthly")
    )
    error = (
        F.when(n < 4, "path structure")
        .when(F.size(name) < 3, "file name structure")
        .when(~file_variable.eqNullSafe(variable), "variable mismatch")
        .when(~F.try_element_at(name, F.lit(3)).eqNullSafe(dataset), "dataset mismatch")
        .when(grain.isNotNull(), F.lit(None))
        .when(~F.coalesce(F.contains(token, F.lit("-")), F.lit(False)), "date format")
        .when(first.isNull() | last.isNull(), "date range format")
        .otherwise("grain of date range")
    )

    def valid(value: Column) -> Column:
        return F.when(error.isNull(), value)

    level = F.nullif(F.regexp_extract(head, "([0-9]+)$", 1), F.lit(""))
    return F.struct(
        valid(F.array_join(F.slice(parts, F.lit(1), F.greatest(n - 5, F.lit(0))), "/")).alias("directory"),
        valid(grain).alias("grain"),
        valid(dataset).alias("dataset"),
        valid(F.coalesce(day, first)).alias("date"),
        valid(variable).alias("variable"),
        valid(level).alias("level"),
        error.alias("error"),
    )


def grid_store(variable: Column, level: Column) -> Column:
    return F.format_string("%s_%s_ERA5_gridded.zarr", variable, level)


def region_store(variable: Column, level: Column, region_set: Column) -> Column:
    return F.format_string("%s_%s_ERA5_%s.zarr", variable, level, region_set)
