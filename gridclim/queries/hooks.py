"""User-defined hooks: direct functions, reducers, adapters, variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import CELL
from ..model import MONTHLY, NEEDS_HISTORY, NEEDS_PERCENTILE, SEASONAL, IndexDef, PercentileSpec, Threshold, YearSpan
from ..operators import indices, percentiles, resample
from ..sources import tables
from . import query
from . import sql as q
from .common import r6, text


def _anomaly(df, context):
    """Period mean minus the mean of the history."""
    v = context.variable
    normal = context.history.groupBy(*CELL).agg(F.avg(v).alias("normal"))
    now = resample.resample(df, context.freq, {v: F.avg(v)})
    return now.join(normal, list(CELL)).withColumn(v, F.col(v) - F.col("normal")).drop("normal")


@query(
    "f1_direct_hook_with_history",
    q.with_(q.GRID)
    + f""", n AS (SELECT lat, lon, avg(tas) AS normal FROM grid WHERE year(time) <= 1998 GROUP BY 1, 2),
    m AS (SELECT lat, lon, {q.month()} AS time, avg(tas) AS tas FROM grid WHERE year(time) > 1998 GROUP BY 1, 2, 3)
    SELECT lat, lon, CAST(time AS VARCHAR) AS time, round(tas - normal, 6) AS value FROM m JOIN n USING (lat, lon)""",
)
def f1_history(spark, sf):
    grid = tables.grid_daily(spark, sf)
    anomaly = IndexDef("anomaly", "Anomaly", "degC", ("tas",), direct=_anomaly, needs=NEEDS_HISTORY)
    out = indices.compute_index(
        grid.where(F.year("time") > 1998), anomaly, MONTHLY, history=grid.where(F.year("time") <= 1998)
    )
    return out.select(*CELL, text("time").alias("time"), r6("value").alias("value"))


def _excess(df, context):
    """Sum of what lies above the reference percentile of the season."""
    v = F.col(context.variable)
    joined = percentiles.join_period_percentile(df, context.percentile, context.freq)
    return resample.resample(
        joined, context.freq, {context.variable: F.sum(F.greatest(v - F.col("q"), F.lit(0.0)))}
    )


@query(
    "f1_direct_hook_with_percentile",
    q.with_(q.GRID)
    + f""", k AS (SELECT *, {q.season()} AS s FROM grid), p AS (SELECT lat, lon, month(s) AS m, quantile_cont(tasmax, 0.9) AS q
      FROM k WHERE year(time) <= 1999 GROUP BY 1, 2, 3)
    SELECT k.lat, k.lon, CAST(s AS VARCHAR) AS time, round(sum(greatest(tasmax - q, 0)), 6) AS value
    FROM k JOIN p ON k.lat = p.lat AND k.lon = p.lon AND month(k.s) = p.m GROUP BY 1, 2, 3""",
)
def f1_percentile(spark, sf):
    excess = IndexDef(
        "excess",
        "Heat excess",
        "degC",
        ("tasmax",),
        direct=_excess,
        needs=NEEDS_PERCENTILE,
        percentile=PercentileSpec(90, span=YearSpan(None, 1999)),
    )
    out = indices.compute_index(tables.grid_daily(spark, sf), excess, SEASONAL)
    return out.select(*CELL, text("time").alias("time"), r6("value").alias("value"))


@query(
    "f2_reducer_hook",
    q.with_(q.GRID)
    + f"""SELECT lat, lon, CAST({q.season()} AS VARCHAR) AS time,
      CASE WHEN count(tas) >= 75 THEN round(max(tas) - min(tas), 6) END AS value FROM grid GROUP BY 1, 2, 3""",
)
def f2(spark, sf):
    spread = IndexDef(
        "spread", "Range", "degC", ("tas",), reducer=lambda v: F.max(v) - F.min(v)
    )
    out = indices.compute_index(tables.grid_daily(spark, sf), spread, SEASONAL)
    return out.select(*CELL, text("time").alias("time"), r6("value").alias("value"))


@query(
    "f3_lifted_function",
    q.with_(q.GRID) + "SELECT lat, lon, round(sum(sqrt(pr)), 5) AS root FROM grid GROUP BY 1, 2",
)
def f3(spark, sf):
    out = tables.grid_daily(spark, sf).transform(resample.lift(F.sqrt, "pr", "root"))
    return out.groupBy(*CELL).agg(F.round(F.sum("root"), 5).alias("root"))


@query(
    "f4_guarded_reducer",
    q.with_(q.GRID)
    + f"""SELECT lat, lon, CAST({q.year()} AS VARCHAR) AS time, CASE WHEN count(tas) >= 12 THEN round(avg(tas), 6) END AS value
    FROM (SELECT lat, lon, {q.month()} AS time, avg(tas) AS tas FROM grid GROUP BY 1, 2, 3) GROUP BY 1, 2, 3""",
)
def f4(spark, sf):
    monthly = resample.resample(tables.grid_daily(spark, sf), MONTHLY, {"tas": F.avg("tas")})
    guarded = resample.guarded(F.avg, "YS", sample=MONTHLY)
    out = resample.resample(monthly, "YS", {"value": r6(guarded(F.col("tas")))})
    return out.withColumn("time", text("time"))


@query(
    "f5_index_variant",
    q.with_(q.GRID)
    + f"""SELECT lat, lon, CAST({q.month()} AS VARCHAR) AS time, CAST(count(*) FILTER (WHERE tasmax > 25) AS DOUBLE) AS value
    FROM grid GROUP BY 1, 2, 3""",
)
def f5(spark, sf):
    tx25 = indices.get_index("tx30").index.variant(name="tx25", options={"test": Threshold(25, "gt")})
    out = indices.compute_index(tables.grid_daily(spark, sf), tx25, MONTHLY)
    return out.withColumn("time", text("time"))


@query(
    "f6_index_config",
    q.with_(q.GRID)
    + f"""SELECT 'Number of days with maximum temperature above 40°C at MS, QS-DEC, YS' AS config, freq, CAST(sum(v) AS BIGINT) AS days FROM (
      SELECT 'MS' AS freq, count(*) FILTER (WHERE tasmax > 40) AS v FROM grid
      UNION ALL SELECT 'QS-DEC', count(*) FILTER (WHERE tasmax > 40) FROM grid
      UNION ALL SELECT 'YS', count(*) FILTER (WHERE tasmax > 40) FROM grid) GROUP BY 1, 2""",
)
def f6(spark, sf):
    config = indices.get_index("tx40")
    out = indices.count_indices(tables.grid_daily(spark, sf), (config.index.name,), config.freqs)
    return out.groupBy(F.lit(str(config)).alias("config"), "freq").agg(
        F.sum("value").cast("bigint").alias("days")
    )
