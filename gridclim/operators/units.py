"""Unit conversion and unit checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import registries
from ..functions import numeric
from ..model import IndexDef, require_columns


def convert_units(df: DataFrame, profile: str | None = None, on_unknown: str = "error") -> DataFrame:
    """Convert ``value`` from ``unit`` to the unit its ``variable`` is stored in.

    Adds ``status``: ``no_target``, ``no_unit``, ``same``, ``converted`` or
    ``unknown``. An unknown unit fails the job, or with ``on_unknown="reject"``
    only marks the row.
    """
    require_columns(df, ["variable", "unit", "value"])
    spark = df.sparkSession
    units = F.broadcast(registries.units_table(spark, profile))  # a few dozen constants
    targets = F.broadcast(registries.targets_table(spark))
    status = (
        F.when(F.col("target").isNull(), "no_target")
        .when(F.col("unit").isNull(), "no_unit")
        .when(F.col("unit") == F.col("target"), "same")
        .when(F.col("scale").isNotNull(), "converted")
        .otherwise("unknown")
    )
    out = df.join(targets, "variable", "left").join(units, "unit", "left").withColumn("status", status)
    if on_unknown == "error":
        out = out.withColumn(
            "status",
            F.when(
                F.col("status") == "unknown",
                F.raise_error(F.concat(F.lit("unknown unit "), F.col("unit"))).cast("string"),
            ).otherwise(F.col("status")),
        )
    done = F.col("status") == "converted"
    value = F.when(
        done, numeric.affine(F.col("value"), F.col("scale"), F.col("offset"))
    ).otherwise(F.col("value"))
    return out.withColumns(
        {"value": value, "unit": F.when(done, F.col("out_unit")).otherwise(F.col("unit"))}
    ).select(*df.columns, "status")


def convert_columns(df: DataFrame, units: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """The same for a wide grid whose units are known when the plan is built."""
    changed, labels = {}, dict(units)
    for variable, unit in units.items():
        target = registries.TARGET_UNITS.get(variable)
        if target is None or unit is None or unit == target:
            continue
        if unit not in registries.UNIT_FACTORS:
            raise KeyError(f"unknown unit {unit!r} of {variable}")
        scale, offset, out = registries.UNIT_FACTORS[unit]
        changed[variable] = F.col(variable) * float(scale) + float(offset)
        labels[variable] = out
    return (df.withColumns(changed) if changed else df), labels


# Unit spellings that mean the same to an index.
SAME_UNITS = (("degC", "Celsius", "C"), ("mm day-1", "mm", "mm/day", "mm day**-1"), ("m s-1", "m/s", "m s**-1"))


def relabel_units(df: DataFrame) -> DataFrame:
    """Set ``unit`` to what an index expects of its ``variable``, without rescaling.

    A variable outside the registry or a missing unit fails the job. Adds
    ``relabelled``.
    """
    expected = F.broadcast(registries.variables_table(df.sparkSession))
    joined = df.join(expected, "variable", "left")
    problem = F.when(
        F.col("long_name").isNull(), F.concat(F.lit("variable not found: "), F.col("variable"))
    ).when(F.col("unit").isNull(), F.concat(F.lit("no unit for "), F.col("variable")))
    wanted = F.coalesce(F.col("expected_unit"), F.col("unit"))
    checked = F.when(problem.isNotNull(), F.raise_error(problem).cast("string")).otherwise(wanted)
    return joined.withColumns(
        {"unit": checked, "relabelled": F.coalesce(F.col("unit") != F.col("expected_unit"), F.lit(False))}
    ).drop("long_name", "expected_unit")


def check_inputs(df: DataFrame, index: IndexDef, units: dict[str, str] | None = None) -> DataFrame:
    """Fail at plan-build time on absent variables or, when units are given, wrong ones."""
    require_columns(df, index.inputs)
    for variable in index.inputs if units is not None else ():
        wanted, found = registries.VARIABLES[variable][1], units.get(variable)
        same = wanted == found or any(wanted in s and found in s for s in SAME_UNITS)
        if not same:
            raise ValueError(f"{variable} is in {found}, expected {wanted}")
    return df


def wind_from_components(df: DataFrame, u: str = "u10", v: str = "v10") -> DataFrame:
    """``sfcWind`` from its two components, which are dropped."""
    require_columns(df, [u, v])
    return df.withColumn("sfcWind", numeric.wind_speed(F.col(u), F.col(v))).drop(u, v)


# Variables that need more than renaming when they are read.
TRANSFORMS: dict[str, Callable[[DataFrame], DataFrame]] = {"sfcWind": wind_from_components}


def apply_transform(df: DataFrame, variable: str) -> DataFrame:
    return df.transform(TRANSFORMS[variable]) if variable in TRANSFORMS else df
