"""Whole flows: daily cells to regional indices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import indices
from ..plans import derived_index
from ..sources import tables
from . import query
from . import sql as q
from .aggregations import _COMBINED
from .common import r6, text, xwalk
from .joins import DOY, STRETCH

_REGIONAL = (
    _COMBINED.rstrip()
    + ", "
    + q.XWALK
    + """
  SELECT region_set, region, index, CAST(time AS VARCHAR) AS time, time_filter, round(sum(value * w) / sum(w), 6) AS value
  FROM {source} JOIN xwalk USING (lat, lon) GROUP BY 1, 2, 3, 4, 5"""
)


def _regional(spark, sf, names):
    out = derived_index.regional_indices(tables.grid_daily(spark, sf), xwalk(spark, sf), names)
    return out.select(
        "region_set", "region", "index", text("time").alias("time"), "time_filter", r6("value").alias("value")
    )


@query(
    "flagship_regional_hot_days",
    _REGIONAL.replace("{source}", "(SELECT * FROM combined WHERE index = 'tx30')"),
)
def hot_days(spark, sf):
    return _regional(spark, sf, ("tx30",))


@query("flagship_regional_count_indices", _REGIONAL.replace("{source}", "combined"))
def all_counts(spark, sf):
    return _regional(spark, sf, indices.COUNT_INDICES)


_SHARES = (
    "share_days AS (SELECT g.lat, g.lon, g.time AS day, g.pr, p.q FROM grid g LEFT JOIN pct p "
    "ON g.lat = p.lat AND g.lon = p.lon AND dayofyear(g.time) = p.doy), share_f AS ("
    + q.union(*[f"SELECT '{f}' AS freq, {q.start(f, 'day')} AS time, * FROM share_days" for f in q.STARTS])
    + """), shares AS (SELECT freq, lat, lon, time, coalesce(sum(pr) FILTER (WHERE pr > q AND pr > 1), 0) AS over,
      coalesce(sum(pr) FILTER (WHERE pr > 1), 0) AS total FROM share_f GROUP BY 1, 2, 3, 4),
    share_kept AS (SELECT s.lat, s.lon, s.freq, 'r95ptot' AS index, s.time,
      CASE WHEN total = 0 THEN NULL ELSE over / total END AS value
      FROM shares s JOIN complete c ON s.freq = c.freq AND s.time = c.time),
    nine AS (SELECT lat, lon, index, time, time_filter, value FROM combined UNION ALL SELECT lat, lon, index, """
    + f"{q.reference()}, {q.filter_name()}, value FROM share_kept)"
)


@query(
    "flagship_regional_all_indices_stored_form",
    ", ".join([_COMBINED.rstrip(), DOY, STRETCH, _SHARES, q.XWALK])
    + """, stored AS (SELECT region_set, region, index, time, time_filter, CAST(sum(value * w) /
        sum(CASE WHEN value IS NOT NULL THEN w END) AS FLOAT) AS value
      FROM nine JOIN xwalk USING (lat, lon) GROUP BY 1, 2, 3, 4, 5)
    SELECT region_set, index, time_filter, count(*) AS n, round(avg(CAST(value AS DOUBLE)), 5) AS mean FROM stored GROUP BY 1, 2, 3""",
)
def all_indices(spark, sf):
    """All nine indices with values as they are stored, in FLOAT."""
    names = (*indices.COUNT_INDICES, "r95ptot")
    regional = derived_index.regional_indices(tables.grid_daily(spark, sf), xwalk(spark, sf), names)
    out = derived_index.to_sink(regional)
    return out.groupBy("region_set", "index", "time_filter").agg(
        F.count("*").alias("n"), F.round(F.avg(F.col("value").cast("double")), 5).alias("mean")
    )
