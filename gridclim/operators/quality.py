"""Summaries that show whether a dataset is sound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import CELL
from ..functions import axis, special


def axis_sizes(df: DataFrame, dims: tuple[str, ...] = ("time", "lat", "lon")) -> list[Column]:
    """Distinct labels per axis, each counted on its own: a scan of one column with a
    partial distinct in every task."""
    return [axis.scalar(df.select(d).distinct(), F.count(d)).alias(f"n_{d}") for d in dims]


def profile(df: DataFrame, dims: tuple[str, ...] = ("time", "lat", "lon")) -> DataFrame:
    """Long form ``dim, size`` of a store."""
    sizes = df.sparkSession.range(1).select(*axis_sizes(df, dims))
    pairs = [F.struct(F.lit(d).alias("dim"), F.col(f"n_{d}").alias("size")) for d in dims]
    return sizes.select(F.explode(F.array(*pairs)).alias("p")).select("p.dim", "p.size")


def _counts(value: Column) -> list[Column]:
    present = F.when(F.col("total") > 0, F.col("valid") / F.col("total") * 100)
    return [(F.col("total") - F.col("valid")).alias("missing"), present.alias("pct_valid")]


def dataset_summary(df: DataFrame, variable: str) -> DataFrame:
    """Total, valid and missing points of the full box, share valid, min and max."""
    value = F.col(variable)
    base = (
        df.agg(F.count(value).alias("valid"), F.min(value).alias("min"), F.max(value).alias("max"))
        .select("*", *axis_sizes(df))
        .withColumn("total", F.col("n_time") * F.col("n_lat") * F.col("n_lon"))
    )
    return base.select("total", "valid", *_counts(value), "min", "max")


def step_summary(df: DataFrame, variable: str, positions: DataFrame) -> DataFrame:
    """Statistics of the time steps listed in ``positions(time, position)``.

    The list is no longer than the time axis, which the calendar bounds, so it is
    broadcast.
    """
    value = F.col(variable)
    n_lat, n_lon = (axis.scalar(df.select(d).distinct(), F.count(d)) for d in CELL)
    stats = (
        df.join(F.broadcast(positions), "time")
        .groupBy("time", "position")
        .agg(
            F.count(value).alias("valid"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.avg(value).alias("mean"),
            F.stddev_pop(value).alias("std"),
        )
        .withColumn("total", n_lat * n_lon)
    )
    return stats.select(
        "time", "position", "total", "valid", *_counts(value), "min", "max", "mean", "std"
    )


def first_middle_last(df: DataFrame) -> DataFrame:
    """Positions 0, n div 2 and n-1 of the time axis."""
    positions = axis.time_positions(df)
    n = axis.time_axis(df).select(F.count("*").alias("n")).scalar()
    p = F.col("position")
    return positions.where((p == 0) | (p == F.floor(n / 2)) | (p == n - 1))


def random_steps(df: DataFrame, k: int = 5, seed: int = 0) -> DataFrame:
    """``k`` time steps drawn without replacement: those with the smallest hash of seed
    and label, whatever the partitioning."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.col("time").cast("string")))
    return axis.time_positions(df).orderBy(drawn, "time").limit(k)


def suspicious_values(df: DataFrame, variable: str, steps: int | None = None) -> DataFrame:
    """Whether any value is infinite, zero or negative; with ``steps`` in the first ones only."""
    value = F.col(variable)
    inf = F.lit(float("inf"))
    rows = df
    if steps is not None:
        head = axis.time_axis(df).orderBy("time").limit(steps)
        rows = df.join(head, "time", "left_semi")

    def any_of(cond: Column) -> Column:
        return F.coalesce(F.bool_or(cond), F.lit(False))

    return rows.agg(
        any_of(F.abs(value) == inf).alias("has_inf"),
        any_of(value == 0).alias("has_zero"),
        any_of(value < 0).alias("has_negative"),
    )


def nearest_cell(df: DataFrame, lat: float, lon: float) -> DataFrame:
    """The series of the cell nearest to a point, chosen per axis; of two the larger."""

    def closest(name: str, target: float) -> Column:
        best = F.min_by(name, F.struct(F.abs(F.col(name) - target), -F.col(name)))
        return axis.scalar(df, best)

    return df.where(
        (F.col("lat") == closest("lat", float(lat))) & (F.col("lon") == closest("lon", float(lon)))
    )


def series_summary(df: DataFrame, variable: str, keys: tuple[str, ...] = CELL) -> DataFrame:
    """Size, missing values, mean, population deviation, extremes and median."""
    value = F.col(variable)
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        (F.count("*") - F.count(value)).alias("missing"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.median(value).alias("median"),
    )


def linear_trend(df: DataFrame, variable: str, keys: tuple[str, ...] = CELL) -> DataFrame:
    """Slope per year of 365.25 days, intercept at the first present value, correlation,
    two-sided p-value of a slope of zero, and the slope's standard error.

    Missing unless more than two values are present; without any variation the
    correlation and its p-value are missing.
    """
    value = F.col(variable)
    years = F.when(value.isNotNull(), F.datediff("time", F.lit("1970-01-01")) / 365.25)
    fit = df.withColumn("_x", years).groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.regr_slope(value, F.col("_x")).alias("slope"),
        F.regr_intercept(value, F.col("_x")).alias("at_zero"),
        F.min("_x").alias("x0"),
        F.regr_sxx(value, F.col("_x")).alias("sxx"),
        F.regr_syy(value, F.col("_x")).alias("syy"),
        F.regr_sxy(value, F.col("_x")).alias("sxy"),
    )
    enough = F.col("n") > 2
    left = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    r = F.try_divide("sxy", F.sqrt(F.col("sxx") * F.col("syy")))  # missing where either does not vary
    fit = fit.withColumn("r", F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(r, F.lit(1.0)))))
    p_value = special.correlation_p_value(F.col("r"), F.col("n"))
    return fit.select(
        *keys,
        "n",
        F.when(enough, F.col("slope")).alias("slope"),
        F.when(enough, F.col("at_zero") + F.col("slope") * F.col("x0")).alias("intercept"),
        F.when(enough, F.col("r")).alias("r"),
        F.when(enough & F.col("r").isNotNull(), p_value).alias("p_value"),
        F.when(enough, F.sqrt(F.try_divide(left, F.col("sxx") * (F.col("n") - 2)))).alias("std_err"),
    )


def decade_distribution(df: DataFrame, variable: str, keys: tuple[str, ...] = CELL) -> DataFrame:
    """Box statistics per decade."""
    value = F.col(variable)
    rows = df.where(value.isNotNull()).withColumn(
        "decade", (F.floor(F.year("time") / 10) * 10).cast("int")
    )
    quartiles = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        rows.groupBy(*keys, "decade")
        .agg(
            F.count("*").alias("n"),
            F.min(value).alias("min"),
            quartiles.alias("q"),
            F.max(value).alias("max"),
            F.avg(value).alias("mean"),
            F.stddev_pop(value).alias("std"),
        )
        .select(
            *keys,
            "decade",
            "n",
            "min",
            F.col("q")[0].alias("q25"),
            F.col("q")[1].alias("q50"),
            F.col("q")[2].alias("q75"),
            "max",
            "mean",
            "std",
        )
    )


def moving_mean(
    df: DataFrame, variable: str, width: int = 12, minimum: int = 6, keys: tuple[str, ...] = CELL
) -> DataFrame:
    """Centred moving mean over rows; an even width reaches one further back."""
    before = width // 2
    frame = Window.partitionBy(*keys).orderBy("time").rowsBetween(-before, width - 1 - before)
    value = F.col(variable)
    return df.withColumn(
        "moving_mean", F.when(F.count(value).over(frame) >= minimum, F.avg(value).over(frame))
    )


def step_deltas(df: DataFrame, keys: tuple[str, ...] = CELL) -> DataFrame:
    """``days`` since the row before, per key."""
    ordered = Window.partitionBy(*keys).orderBy("time")
    return df.withColumn("days", F.datediff("time", F.lag("time").over(ordered)))
