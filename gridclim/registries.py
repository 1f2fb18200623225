"""Units, variables, request names and calendar names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import small_table

# Source unit -> (scale, offset, resulting unit).
UNIT_FACTORS = {
    "Kelvin": (1, -273.15, "Celsius"),
    "kelvin": (1, -273.15, "Celsius"),
    "1": (1000, 0, "gr kg-1"),
    "K": (1, -273.15, "Celsius"),
    "Fahrenheit": (5 / 9, -32 * 5 / 9, "Celsius"),
    "Celsius": (1, 0, "Celsius"),
    "kg kg-1": (1000, 0, "gr kg-1"),
    "degrees Celsius": (1, 0, "Celsius"),
    "degC": (1, 0, "Celsius"),
    "m hour**-1": (1000 * 24, 0, "mm"),
    "mm day**-1": (1, 0, "mm"),
    "mm/day": (1, 0, "mm"),
    "mm": (1, 0, "mm"),
    "m": (1000, 0, "mm"),
    "mm s**-1": (3600 * 24, 0, "mm"),
    "m**3 m**-3": (100, 0, "kg m-2"),
    "kg m**-2 day**-1": (1, 0, "mm"),
    "kg m-2 s-1": (3600 * 24, 0, "mm"),
    "kg m**-2": (1, 0, "mm"),
    "kg m-2": (1, 0, "mm"),
    "C": (1, 0, "Celsius"),
    "(0 - 1)": (100, 0, "%"),
    "Fraction": (100, 0, "%"),
    "m of water equivalent": (1000, 0, "mm"),
    "m s**-1": (1, 0, "m s-1"),
    "m s-1": (1, 0, "m s-1"),
    "m/s": (1, 0, "m s-1"),
    "km h**-1": (10 / 36, 0, "m s-1"),
    "W/m2": (1, 0, "W m-2"),
    "Pa": (0.01, 0, "hPa"),
    "knots": (0.51, 0, "m s-1"),
    "kts": (0.51, 0, "m s-1"),
    "mph (nautical miles per hour)": (0.51, 0, "m s-1"),
    "%": (1, 0, "%"),
    "W m**-2": (1, 0, "W m-2"),
    "J m**-2": (1 / 3600, 0, "W m-2"),
}

# Factors that replace the ones above for other kinds of input.
UNIT_PROFILES = {
    "hourly_to_daily": {
        "mm s**-1": (3600, 0, "mm"),
        "m hour**-1": (1000, 0, "mm"),
        "kg m-2 s-1": (3600, 0, "mm"),
    },
    "special": {
        "kg m-2 s-1": (-3600, 0, "mm"),
    },
    "monthly": {
        "J m**-2": (1 / (3600 * 24), 0, "W m-2"),
        "m": (-1000, 0, "mm"),
        "m of water equivalent": (-1000, 0, "mm"),
    },
}

# Variable -> unit it is stored in.
TARGET_UNITS = {
    "tas": "Celsius",
    "t2m": "Celsius",
    "2t": "Celsius",
    "mx2t": "Celsius",
    "tasmax": "Celsius",
    "tasmin": "Celsius",
    "hurs": "%",
    "clt": "%",
    "evspsbl": "mm",
    "pr": "mm",
    "psl": "hPa",
    "prsn": "mm",
    "siconc": "%",
    "sfcWind": "m s-1",
    "uwind": "m s**-1",
    "vwind": "m s**-1",
    "mrsos": "kg m-2",
    "mrro": "kg m-2",
    "huss": "gr kg-1",
    "sst": "Celsius",
    "rlds": "W m-2",
    "rsds": "W m-2",
    "ps": "Pa",
    "2d": "Celsius",
    "mslp": "Pa",
    "z": "m**2 s**-2",
}

# Variable -> (long name, unit an index expects).
VARIABLES = {
    "tas": ("Mean temperature", "degC"),
    "tasrange": ("Temperature range", "degC"),
    "tasskew": ("Temperature skewness", "degC"),
    "pr": ("total_precipitation", "mm day-1"),
    "tasmin": ("Minimum temperature", "degC"),
    "tasminbaisimip": ("Minimum temperature with bias adjustment", "degC"),
    "tasmax": ("Maximum temperature", "degC"),
    "psl": ("Sea level pressure", "Pa"),
    "sst": ("Sea surface temperature", "degC"),
    "siconc": ("Sea ice area fraction", "fraction"),
    "prsn": ("Accumulated snowfall precipitation", "mm"),
    "sfcWind": ("Surface Wind", "m s-1"),
    "clt": ("Cloud area fraction", "percent"),
    "stl1": ("Soil Temperature level 1", "degC"),
    "rsds": ("Surface downwelling shortwave radiation", "W m-2"),
    "rlds": ("Surface downwelling longwave radiation", "W m-2"),
    "rsus": ("Surface upwelling shortwave radiation", "W m-2"),
    "rlus": ("Surface upwelling longwave radiation", "W m-2"),
    "mrsos": ("Moisture in upper portion of soil column", "kg m-2"),
    "huss": ("Near-surface specific humidity", "kg kg -1"),
    "hurs": ("Relative humidity", None),
    "dp": ("Dew point", "degC"),
    "evspsbl": ("Evaporation", "mm"),
    "mrro": ("Total runoff", "kg m-2"),
    "pethg": ("Potential Evapotranspiration", "mm"),
    "prmax_24h": ("Maximum 24h precipitation", "mm"),
}

# The daily-statistics product: variable -> (request names, statistic).
DAILY_STATISTICS = "derived-era5-single-levels-daily-statistics"
REQUEST_NAMES = {
    "tas": (("2m_temperature",), "daily_mean"),
    "tasmax": (("maximum_2m_temperature_since_previous_post_processing",), "daily_maximum"),
    "tasmin": (("minimum_2m_temperature_since_previous_post_processing",), "daily_minimum"),
    "pr": (("total_precipitation",), "daily_sum"),
    "sfcWind": (
        ("10m_u_component_of_neutral_wind", "10m_v_component_of_neutral_wind"),
        "daily_mean",
    ),
}

# Fields a request carries besides the common ones, per product.
REQUEST_FIELDS = {
    "derived-era5-single-levels-daily-statistics": ("frequency", "daily_statistic", "time_zone"),
    "derived-era5-pressure-levels-daily-statistics": (
        "daily_statistic",
        "frequency",
        "pressure_level",
        "time_zone",
    ),
    "reanalysis-era5-single-levels": ("data_format", "download_format", "time"),
    "reanalysis-era5-pressure-levels": (
        "data_format",
        "pressure_level",
        "download_format",
        "time",
    ),
}

# Time filters and their month ranges.
TIME_FILTERS = {
    "Annual": "01-12",
    "DecFeb": "12-02",
    "MarMay": "03-05",
    "JunAug": "06-08",
    "SepNov": "09-11",
    "Jan": "01-01",
    "Feb": "02-02",
    "Mar": "03-03",
    "Apr": "04-04",
    "May": "05-05",
    "Jun": "06-06",
    "Jul": "07-07",
    "Aug": "08-08",
    "Sep": "09-09",
    "Oct": "10-10",
    "Nov": "11-11",
    "Dec": "12-12",
}

# Named year ranges per marine and wind variable.
_SPANS = {
    "baseline": "1995-2014",
    "near_future": "2021-2040",
    "medium_future": "2041-2060",
    "far_future": "2081-2100",
}
_FULL = ("baseline", "near_future", "medium_future", "far_future")
PERIODS = {
    "water_level": ("baseline", "near_future"),
    "waves_dir": ("baseline",),
    "waves_dp": _FULL,
    "waves_dpt": ("baseline",),
    "waves_fp": ("baseline",),
    "waves_hs": _FULL,
    "waves_t02": ("baseline",),
    "waves_t0m1": ("baseline",),
    "waves_tp": _FULL,
    "waves_VPED": ("baseline",),
    "waves_VTPK": ("baseline",),
    "wind_100m": _FULL,
    "wind_10m": _FULL,
    "wind_150m": _FULL,
    "wind_200m": _FULL,
    "wind_dd": ("baseline",),
}

# Store name templates.
GRID_STORE_NAME = "{variable}_{level}_ERA5_gridded.zarr"
REGION_STORE_NAME = "{variable}_{level}_ERA5_{region_set}.zarr"


def units_table(spark: SparkSession, profile: str | None = None) -> DataFrame:
    """``unit, scale, offset, out_unit``; a profile overrides some rows."""
    factors = dict(UNIT_FACTORS)
    if profile is not None:
        factors.update(UNIT_PROFILES[profile])
    rows = [(u, float(s), float(o), out) for u, (s, o, out) in factors.items()]
    return small_table(spark, rows, "unit string, scale double, offset double, out_unit string")


def profiles_table(spark: SparkSession) -> DataFrame:
    """All override factors, keyed by profile."""
    rows = [
        (p, u, float(s), float(o), out)
        for p, factors in UNIT_PROFILES.items()
        for u, (s, o, out) in factors.items()
    ]
    return small_table(
        spark, rows, "profile string, unit string, scale double, offset double, out_unit string"
    )


def targets_table(spark: SparkSession) -> DataFrame:
    return small_table(spark, list(TARGET_UNITS.items()), "variable string, target string")


def variables_table(spark: SparkSession) -> DataFrame:
    rows = [(v, name, unit) for v, (name, unit) in VARIABLES.items()]
    return small_table(spark, rows, "variable string, long_name string, expected_unit string")


def request_names_table(spark: SparkSession) -> DataFrame:
    rows = [(v, list(names), stat) for v, (names, stat) in REQUEST_NAMES.items()]
    return small_table(
        spark, rows, "variable string, request_names array<string>, statistic string"
    )


def time_filters_table(spark: SparkSession) -> DataFrame:
    rows = [(n, r, int(r[:2]), int(r[3:])) for n, r in TIME_FILTERS.items()]
    return small_table(
        spark, rows, "time_filter string, months string, first_month int, last_month int"
    )


def filter_months(spark: SparkSession) -> DataFrame:
    """``time_filter, months, month``: every month of every filter."""
    low, high = F.col("first_month"), F.col("last_month")
    year = F.sequence(F.lit(1), F.lit(12))
    inside = F.filter(
        year,
        lambda m: F.when(low <= high, m.between(low, high)).otherwise((m >= low) | (m <= high)),
    )
    return time_filters_table(spark).select("time_filter", "months", F.explode(inside).alias("month"))


def period_years(spark: SparkSession) -> DataFrame:
    """``variable, period, year``: every year of every named period."""
    years = F.sequence("first_year", "last_year")
    return periods_table(spark).select("variable", "period", F.explode(years).alias("year"))


def periods_table(spark: SparkSession) -> DataFrame:
    rows = [
        (v, p, int(_SPANS[p][:4]), int(_SPANS[p][5:])) for v, names in PERIODS.items() for p in names
    ]
    return small_table(
        spark, rows, "variable string, period string, first_year int, last_year int"
    )
