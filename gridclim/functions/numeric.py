"""Missing values, weights and quantiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def missing_to_null(value: Column) -> Column:
    """NaN is missing everywhere in this package, and missing is NULL."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def affine(value: Column, scale: Column, offset: Column) -> Column:
    return value * scale + offset


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(F.pow(u, 2) + F.pow(v, 2))


def latitude_weight(lat: Column) -> Column:
    return F.cos(F.radians(lat))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean over present values only; NULL when none is present."""
    present = F.when(value.isNotNull(), weight)
    return F.try_divide(F.sum(value * weight), F.sum(present))


def complete_only(aggregate: Column, value: Column) -> Column:
    """An aggregate that is NULL as soon as one input is missing."""
    return F.when(F.count(value) == F.count(F.lit(1)), aggregate)


def at_least(aggregate: Column, value: Column, minimum: int) -> Column:
    """An aggregate that is NULL below a number of present inputs."""
    return F.when(F.count(value) >= minimum, aggregate)


def plotting_quantile(values: Column, p: float, alpha: float = 1 / 3, beta: float = 1 / 3) -> Column:
    """Quantile of a sorted array without missing values, by plotting position.

    alpha = beta = 1/3 is the median-unbiased form, alpha = beta = 1 the linear one
    of ``percentile``.
    """
    n = F.size(values)
    position = n * F.lit(p) + F.lit(alpha + p * (1 - alpha - beta))
    position = F.greatest(F.lit(1.0), F.least(position, n.cast("double")))
    low = F.floor(position).cast("int")
    below = F.try_element_at(values, low)
    above = F.try_element_at(values, F.least(low + 1, n))
    return F.when(n > 0, below + (position - low) * (above - below))


def nearest_label(axis: Column, target: Column) -> Column:
    """Entry of an axis array closest to ``target``; of two, the larger."""
    scored = F.transform(
        axis, lambda a: F.struct(F.abs(a - target).alias("d"), (-a).alias("neg"))
    )
    return -F.array_min(scored)["neg"]


def close_to(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Null-safe tolerance test: two missing values agree, one does not."""
    both = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    return F.when(a.isNull() & b.isNull(), F.lit(True)).otherwise(F.coalesce(both, F.lit(False)))
