"""Aggregations over time and space."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import CELL
from ..functions import calendar
from ..model import ANNUAL, MONTHLY, SEASONAL, STANDARD_FREQS, PercentileSpec, Threshold, YearSpan
from ..operators import (
    combine,
    compare,
    completeness,
    indices,
    percentiles,
    quality,
    regions,
    resample,
    temporal,
)
from ..plans import derived_index, incremental
from ..sources import tables
from . import query
from . import sql as q
from .common import flag, r6, text, xwalk
from .joins import DOY, STRETCH, versions

_ALL_STARTS = {**q.STARTS, "W-MON": lambda t: f"CAST(date_trunc('week', {t}) AS DATE)"}


def _resample_sql(freq: str) -> str:
    return q.with_(q.GRID) + f"""SELECT lat, lon, CAST({_ALL_STARTS[freq]('time')} AS VARCHAR) AS time,
      count(*) AS n, round(avg(tas), 6) AS mean, max(tasmax) AS top, round(sum(pr), 6) AS total
    FROM grid GROUP BY 1, 2, 3"""


def _resample(spark, sf, freq):
    out = resample.resample(
        tables.grid_daily(spark, sf),
        freq,
        {
            "n": F.count("*"),
            "mean": r6(F.avg("tas")),
            "top": F.max("tasmax"),
            "total": r6(F.sum("pr")),
        },
    )
    return out.withColumn("time", text("time"))


for _name, _freq in {
    "a1_resample_monthly": MONTHLY,
    "a1_resample_seasonal": SEASONAL,
    "a1_resample_annual": ANNUAL,
    "a2_resample_weekly": "W-MON",
}.items():
    query(_name, _resample_sql(_freq))(lambda spark, sf, f=_freq: _resample(spark, sf, f))


@query(
    "a2_resample_daily",
    q.with_(q.GRID)
    + """SELECT CAST(time AS VARCHAR) AS time, count(*) AS n, round(sum(pr), 6) AS total FROM grid GROUP BY 1""",
)
def a2_daily(spark, sf):
    grid = tables.grid_daily(spark, sf)
    out = resample.resample(grid, "D", {"n": F.count("*"), "total": r6(F.sum("pr"))}, ())
    return out.withColumn("time", text("time"))


def _index_sql(test: str, freq: str) -> str:
    return q.with_(q.GRID) + f"""SELECT lat, lon, CAST({q.start(freq)} AS VARCHAR) AS time,
      CAST(count(*) FILTER (WHERE {test}) AS DOUBLE) AS value FROM grid GROUP BY 1, 2, 3"""


def _index(spark, sf, name, freq):
    out = indices.compute_index(tables.grid_daily(spark, sf), indices.get_index(name).index, freq)
    return out.select(*CELL, text("time").alias("time"), "value")


_COUNTS = {
    "a3_tx30": ("tx30", "tasmax > 30"),
    "a3_tx35": ("tx35", "tasmax > 35"),
    "a3_tx40": ("tx40", "tasmax > 40"),
    "a4_tr20": ("tr20", "tasmin > 20"),
    "a4_tr25": ("tr25", "tasmin > 25"),
    "a5_fd": ("fd", "tasmin < 0"),
    "a6_r1mm": ("r1mm", "pr >= 1"),
    "a6_r20mm": ("r20mm", "pr >= 20"),
}
for _name, (_index_name, _test) in _COUNTS.items():
    for _label, _freq in (("monthly", MONTHLY), ("seasonal", SEASONAL), ("annual", ANNUAL)):
        query(f"{_name}_{_label}", _index_sql(_test, _freq))(
            lambda spark, sf, n=_index_name, f=_freq: _index(spark, sf, n, f)
        )


def _share_sql(freq: str) -> str:
    return q.with_(q.GRID, DOY, STRETCH) + f""", g AS (
      SELECT g.lat, g.lon, {q.start(freq, 'g.time')} AS time, g.pr, p.q
      FROM grid g LEFT JOIN pct p ON g.lat = p.lat AND g.lon = p.lon AND dayofyear(g.time) = p.doy),
    s AS (SELECT lat, lon, time, coalesce(sum(pr) FILTER (WHERE pr > q AND pr > 1), 0) AS over,
      coalesce(sum(pr) FILTER (WHERE pr > 1), 0) AS total FROM g GROUP BY 1, 2, 3)
    SELECT lat, lon, CAST(time AS VARCHAR) AS time,
      CASE WHEN total = 0 THEN NULL ELSE round(over / total, 6) END AS value FROM s"""


for _label, _freq in (("monthly", MONTHLY), ("seasonal", SEASONAL), ("annual", ANNUAL)):

    @query(f"a7_r95ptot_{_label}", _share_sql(_freq))
    def _a7(spark, sf, f=_freq):
        return _index(spark, sf, "r95ptot", f).withColumn("value", r6("value"))


@query(
    "a7_r95ptot_rolled_up",
    q.with_(q.GRID, DOY, STRETCH)
    + ", g AS (SELECT g.lat, g.lon, g.time AS day, g.pr, p.q FROM grid g LEFT JOIN pct p "
    "ON g.lat = p.lat AND g.lon = p.lon AND dayofyear(g.time) = p.doy), f AS ("
    + q.union(*[f"SELECT '{f}' AS freq, {q.start(f, 'day')} AS time, * FROM g" for f in STANDARD_FREQS])
    + """), s AS (SELECT freq, lat, lon, time, coalesce(sum(pr) FILTER (WHERE pr > q AND pr > 1), 0) AS over,
      coalesce(sum(pr) FILTER (WHERE pr > 1), 0) AS total FROM f GROUP BY 1, 2, 3, 4)
    SELECT freq, lat, lon, CAST(time AS VARCHAR) AS time,
      CASE WHEN total = 0 THEN NULL ELSE round(over / total, 6) END AS value FROM s""",
)
def a7_rolled(spark, sf):
    out = indices.precipitation_shares(tables.grid_daily(spark, sf))
    return out.select("freq", *CELL, text("time").alias("time"), r6("r95ptot").alias("value"))


@query(
    "a8_generic_threshold_index",
    q.with_(q.GRID)
    + f"""SELECT lat, lon, CAST({q.month()} AS VARCHAR) AS time,
      CASE WHEN count(*) >= 25 THEN CAST(count(*) FILTER (WHERE tas >= 15) AS DOUBLE) END AS value
    FROM grid GROUP BY 1, 2, 3""",
)
def a8_threshold(spark, sf):
    warm = indices.get_index("tx30").index.variant(
        name="warm", inputs=("tas",), direct=None, threshold=Threshold(15), reducer=F.sum
    )
    out = indices.compute_index(tables.grid_daily(spark, sf), warm, MONTHLY)
    return out.select(*CELL, text("time").alias("time"), "value")


@query(
    "a8_generic_percentile_index",
    q.with_(q.GRID)
    + f""", k AS (SELECT *, strftime(time, '%b') AS period FROM grid),
    p AS (SELECT lat, lon, period, quantile_cont(tasmin, 0.1) AS q FROM k
      WHERE year(time) BETWEEN 1996 AND 1999 GROUP BY 1, 2, 3)
    SELECT k.lat, k.lon, CAST({q.month()} AS VARCHAR) AS time,
      CASE WHEN count(*) >= 25 THEN CAST(count(*) FILTER (WHERE tasmin < q) AS DOUBLE) END AS value
    FROM k LEFT JOIN p USING (lat, lon, period) GROUP BY 1, 2, 3""",
)
def a8_percentile(spark, sf):
    cold = indices.get_index("fd").index.variant(
        name="cold",
        direct=None,
        threshold=None,
        percentile=PercentileSpec(10, op="lt", span=YearSpan(1996, 1999)),
        reducer=F.sum,
    )
    out = indices.compute_index(tables.grid_daily(spark, sf), cold, MONTHLY)
    return out.select(*CELL, text("time").alias("time"), "value")


_LONG_COUNTS = q.union(
    *[
        f"SELECT '{f}' AS freq, lat, lon, {q.start(f)} AS time, '{n}' AS index, "
        f"CAST(count(*) FILTER (WHERE {t}) AS DOUBLE) AS value FROM grid GROUP BY lat, lon, {q.start(f)}"
        for f in STANDARD_FREQS
        for n, t in _COUNTS.values()
    ]
)


@query(
    "a9_all_count_indices",
    q.with_(q.GRID) + f"SELECT freq, lat, lon, CAST(time AS VARCHAR) AS time, index, value FROM ({_LONG_COUNTS})",
)
def a9(spark, sf):
    out = indices.count_indices(tables.grid_daily(spark, sf))
    return out.select("freq", *CELL, text("time").alias("time"), "index", "value")


@query(
    "a10_minimum_samples",
    q.with_(q.GRID)
    + f"""SELECT 'MS' AS freq, lat, lon, CAST({q.month()} AS VARCHAR) AS time,
        CASE WHEN count(tasmax) >= 25 THEN max(tasmax) END AS top FROM grid GROUP BY 2, 3, 4
      UNION ALL SELECT 'QS-DEC', lat, lon, CAST({q.season()} AS VARCHAR),
        CASE WHEN count(tasmax) >= 75 THEN max(tasmax) END FROM grid GROUP BY 2, 3, 4""",
)
def a10(spark, sf):
    grid = tables.grid_daily(spark, sf)

    def part(freq):
        top = resample.guarded(F.max, freq)(F.col("tasmax"))
        out = resample.resample(grid, freq, {"top": top})
        return out.select(F.lit(freq).alias("freq"), *CELL, text("time").alias("time"), "top")

    return part(MONTHLY).unionByName(part(SEASONAL))


@query(
    "a11_expected_counts",
    q.with_(q.GRID, q.periods(), q.EXPECTED)
    + """SELECT freq, CAST(expected AS BIGINT) AS expected, CAST(mode(n) AS BIGINT) AS usual,
      count(*) AS periods FROM periods JOIN expected USING (freq) GROUP BY 1, 2""",
)
def a11(spark, sf):
    counts = completeness.period_counts(tables.grid_daily(spark, sf), STANDARD_FREQS)
    return counts.groupBy("freq", "expected").agg(
        F.mode("n", True).alias("usual"), F.count("*").alias("periods")
    )


@query(
    "a12_complete_periods",
    q.with_(q.GRID, q.periods(), q.COMPLETE) + "SELECT freq, CAST(time AS VARCHAR) AS time FROM complete",
)
def a12(spark, sf):
    out = completeness.complete_periods(tables.grid_daily(spark, sf), STANDARD_FREQS)
    return out.withColumn("time", text("time"))


@query(
    "a12_complete_cell_periods",
    q.with_(q.GRID)
    + f"""SELECT lat, lon, CAST({q.month()} AS VARCHAR) AS time FROM grid GROUP BY 1, 2, 3
    HAVING count(tas) >= 31 * CAST(0.8 AS DOUBLE)""",
)
def a12_cells(spark, sf):
    out = completeness.complete_cell_periods(tables.grid_daily(spark, sf), "tas", MONTHLY)
    return out.withColumn("time", text("time"))


@query(
    "a13_infer_frequency",
    q.with_(q.GRID)
    + f""", t AS (SELECT 'days' AS axis, time FROM grid UNION SELECT 'months', {q.month()} FROM grid
        UNION SELECT 'seasons', {q.season()} FROM grid UNION SELECT 'years', {q.year()} FROM grid
        UNION SELECT 'gaps', time FROM grid WHERE day(time) <> 5),
      d AS (SELECT axis, time, time - lag(time) OVER (PARTITION BY axis ORDER BY time) AS step FROM t)
      SELECT axis, CASE WHEN max(step) = 1 THEN 'D' WHEN min(step) BETWEEN 28 AND 31 AND max(step) = 31 THEN 'MS'
        WHEN min(step) >= 89 AND max(step) <= 92 THEN 'QS-DEC' WHEN min(step) >= 365 THEN 'YS' ELSE 'irregular' END AS freq,
        count(*) AS steps FROM d GROUP BY 1""",
)
def a13(spark, sf):
    days = tables.grid_daily(spark, sf).select("time")
    axes = {"days": days, "gaps": days.where(F.dayofmonth("time") != 5)}
    for name, freq in (("months", MONTHLY), ("seasons", SEASONAL), ("years", ANNUAL)):
        axes[name] = days.select(calendar.period_start(F.col("time"), freq).alias("time"))
    out = None
    for name, df in axes.items():
        part = completeness.frequency_of(df).select(F.lit(name).alias("axis"), "freq", "steps")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "a14_reference_span",
    q.with_(q.GRID)
    + """SELECT lat, lon, count(*) AS n, CAST(min(time) AS VARCHAR) AS first, CAST(max(time) AS VARCHAR) AS last
    FROM grid WHERE time BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY 1, 2""",
)
def a14(spark, sf):
    rows = completeness.reference_rows(
        tables.grid_daily(spark, sf), YearSpan(1996, 1998).contains(F.col("time"))
    )
    return rows.groupBy(*CELL).agg(
        F.count("*").alias("n"), text(F.min("time")).alias("first"), text(F.max("time")).alias("last")
    )


@query(
    "a15_regular_percentile",
    q.with_(q.GRID)
    + """, k AS (SELECT lat, lon, strftime(time, '%b') AS period, tas FROM grid
        UNION ALL SELECT lat, lon, 'Annual', tas FROM grid)
      SELECT lat, lon, period, round(quantile_cont(tas, 0.95), 6) AS q FROM k GROUP BY 1, 2, 3""",
)
def a15(spark, sf):
    grid = tables.grid_daily(spark, sf)
    monthly = percentiles.regular_percentile(grid, "tas", 95, MONTHLY)
    annual = percentiles.regular_percentile(grid, "tas", 95, ANNUAL)
    return monthly.unionByName(annual).withColumn("q", r6("q"))


@query(
    "a16_day_of_year_percentile",
    q.with_(q.GRID, DOY) + "SELECT lat, lon, CAST(doy AS BIGINT) AS doy, round(q, 6) AS q FROM raw",
)
def a16(spark, sf):
    out = percentiles.day_of_year_percentile(tables.grid_daily(spark, sf), "pr", 95, doy_adjust="none")
    return out.select(*CELL, F.col("doy").cast("bigint").alias("doy"), r6("q").alias("q"))


@query(
    "a16_day_of_year_percentile_stretched",
    q.with_(q.GRID, DOY, STRETCH) + "SELECT lat, lon, CAST(doy AS BIGINT) AS doy, round(q, 6) AS q FROM pct",
)
def a16_stretched(spark, sf):
    out = percentiles.day_of_year_percentile(tables.grid_daily(spark, sf), "pr", 95)
    return out.select(*CELL, F.col("doy").cast("bigint").alias("doy"), r6("q").alias("q"))


@query(
    "a17_masked_percentile",
    q.with_(q.GRID)
    + f""", k AS (SELECT lat, lon, {_ALL_STARTS['QS-DEC']('time')} AS s, CASE WHEN pr > 3 THEN pr END AS pr FROM grid)
    SELECT lat, lon, CASE month(s) WHEN 12 THEN 'DecFeb' WHEN 3 THEN 'MarMay' WHEN 6 THEN 'JunAug' ELSE 'SepNov' END AS period,
      round(quantile_cont(pr, 0.75), 6) AS q FROM k GROUP BY 1, 2, 3""",
)
def a17(spark, sf):
    # The mask carries "le", yet it is the percentile's own "gt" that applies.
    spec = PercentileSpec(75, op="gt", mask=Threshold(3.0, "le"))
    out = percentiles.reference_percentile(tables.grid_daily(spark, sf), "pr", spec, SEASONAL)
    return out.withColumn("q", r6("q"))


_SQL_STATS = {"mean": "avg", "max": "max", "min": "min", "std": "stddev_pop", "median": "median", "sum": "sum"}
_WINTER = q.with_(q.GRID) + """, k AS (
  SELECT lat, lon, year(time) + CASE WHEN month(time) = 12 THEN 1 ELSE 0 END AS y,
    CASE WHEN tasmin > 39 THEN NULL ELSE tasmin END AS v
  FROM grid WHERE month(time) IN (12, 1, 2)),
b AS (SELECT year(min(time)) AS y0, year(max(time)) AS y1 FROM grid),
yearly AS (SELECT lat, lon, y, CASE WHEN count(*) = count(v) THEN {f}(v) END AS v
  FROM k, b WHERE y BETWEEN y0 AND y1 GROUP BY 1, 2, 3)
"""


def _gappy(spark, sf):
    grid = tables.grid_daily(spark, sf)
    return grid.select("time", *CELL, F.when(F.col("tasmin") <= 39, F.col("tasmin")).alias("v"))


for _stat, _fn in _SQL_STATS.items():

    @query(
        f"a18_winter_{_stat}",
        _WINTER.format(f=_fn)
        + "SELECT lat, lon, CAST(make_date(y, 1, 1) AS VARCHAR) AS time, round(v, 6) AS v FROM yearly",
    )
    def _a18(spark, sf, s=_stat):
        out = temporal.seasonal_statistic(_gappy(spark, sf), "v", s, "12-02", "temporal_series")
        return out.select(*CELL, text("time").alias("time"), r6("v").alias("v"))


@query(
    "a19_climatology",
    _WINTER.format(f="max") + "SELECT lat, lon, round(avg(v), 6) AS v FROM yearly GROUP BY 1, 2",
)
def a19(spark, sf):
    out = temporal.seasonal_statistic(_gappy(spark, sf), "v", "max", "12-02", "climatology")
    return out.select(*CELL, r6("v").alias("v"))


@query(
    "a20_temporal_series",
    q.with_(q.GRID)
    + """SELECT lat, lon, CAST(make_date(year(time), 1, 1) AS VARCHAR) AS time, round(sum(pr), 6) AS pr
    FROM grid WHERE month(time) BETWEEN 6 AND 8 AND year(time) BETWEEN 1997 AND 2000 GROUP BY 1, 2, year(time)""",
)
def a20(spark, sf):
    out = temporal.seasonal_statistic(
        tables.grid_daily(spark, sf), "pr", "sum", "06-08", "temporal_series", "1997-2000"
    )
    return out.select(*CELL, text("time").alias("time"), r6("pr").alias("pr"))


@query(
    "a21_weighted_mean",
    q.with_(q.GRID, q.CELLS, q.REGIONS, q.INSIDE)
    + """, g AS (SELECT time, lat, lon, CASE WHEN tas > 25 THEN NULL ELSE tas END AS tas FROM grid),
    d AS (SELECT region_set, region, time, sum(tas * cos(radians(lat))) /
        sum(CASE WHEN tas IS NOT NULL THEN cos(radians(lat)) END) AS v
      FROM g JOIN inside USING (lat, lon) GROUP BY 1, 2, 3)
    SELECT region_set, region, CAST(date_trunc('month', time)::DATE AS VARCHAR) AS month, count(v) AS days,
      round(avg(v), 6) AS v FROM d GROUP BY 1, 2, 3""",
)
def a21(spark, sf):
    inside = xwalk(spark, sf).where(~F.col("filled"))
    grid = tables.grid_daily(spark, sf).select(
        "time", *CELL, F.when(F.col("tas") <= 25, F.col("tas")).alias("v")
    )
    daily = regions.aggregate_days(grid, inside, ["v"])
    month = text(calendar.period_start(F.col("time"), MONTHLY)).alias("month")
    return daily.groupBy("region_set", "region", month).agg(
        F.count("v").alias("days"), r6(F.avg("v")).alias("v")
    )


@query(
    "a22_regional_driver",
    q.with_(q.GRID, q.XWALK)
    + """, d AS (SELECT region_set, region, time, sum(pr * w) / sum(w) AS pr, sum(tas * w) / sum(w) AS tas
      FROM grid JOIN xwalk USING (lat, lon) GROUP BY 1, 2, 3)
    SELECT region_set, region, year(time) AS year, count(*) AS days, round(sum(pr), 5) AS pr, round(avg(tas), 6) AS tas
    FROM d GROUP BY 1, 2, 3""",
)
def a22(spark, sf):
    grid = tables.grid_daily(spark, sf)
    daily = regions.aggregate_days(grid, xwalk(spark, sf), ["pr", "tas"])
    return daily.groupBy("region_set", "region", F.year("time").cast("bigint").alias("year")).agg(
        F.count("*").alias("days"), F.round(F.sum("pr"), 5).alias("pr"), r6(F.avg("tas")).alias("tas")
    )


@query(
    "a23_unique_region_names",
    q.with_(q.REGIONS)
    + """SELECT region_set, region, CASE WHEN count(*) OVER (PARTITION BY region_set, name) > 1
      THEN name || ' (' || country || ')' ELSE name END AS label FROM regions""",
)
def a23(spark, sf):
    return regions.unique_names(tables.regions(spark, sf)).select("region_set", "region", "label")


_COMBINED = (
    q.with_(q.GRID, q.periods(), q.COMPLETE)
    + f", counts AS ({_LONG_COUNTS}), kept AS (SELECT c.* FROM counts c JOIN complete p ON c.freq = p.freq AND c.time = p.time), "
    + f"combined AS (SELECT lat, lon, freq, index, {q.reference()} AS time, {q.filter_name()} AS time_filter, "
    "time AS period, value FROM kept) "
)


@query(
    "a24_combine_frequencies",
    _COMBINED
    + """SELECT lat, lon, CAST(time AS VARCHAR) AS time, time_filter, value FROM combined WHERE index = 'tx30'""",
)
def a24(spark, sf):
    grid = tables.grid_daily(spark, sf)
    index = indices.get_index("tx30").index
    periods = completeness.complete_periods(grid, STANDARD_FREQS)
    frames = {
        f: completeness.keep_complete(indices.compute_index(grid, index, f), periods, f)
        for f in STANDARD_FREQS
    }
    return combine.combine(frames).select(*CELL, text("time").alias("time"), "time_filter", "value")


@query(
    "a24_combine_rolled_up",
    _COMBINED
    + """SELECT lat, lon, index, CAST(time AS VARCHAR) AS time, time_filter, CAST(period AS VARCHAR) AS period, value
    FROM combined""",
)
def a24_rolled(spark, sf):
    out = derived_index.cell_indices(tables.grid_daily(spark, sf), indices.COUNT_INDICES)
    return out.select(
        *CELL, "index", text("time").alias("time"), "time_filter", text("period").alias("period"), "value"
    )


@query(
    "a25_checkpoints",
    _COMBINED
    + """, last AS (SELECT index, freq, max(period) AS p FROM combined GROUP BY 1, 2)
    SELECT index, 'last_checkpoint_' || freq AS key, strftime(p, '%Y-%m-%dT00:00:00') AS value FROM last
    UNION ALL SELECT DISTINCT index, 'frequencies_used', 'MS, QS-DEC, YS' FROM last""",
)
def a25(spark, sf):
    cells = derived_index.cell_indices(tables.grid_daily(spark, sf), indices.COUNT_INDICES)
    attrs = combine.checkpoint_attributes(combine.checkpoints(cells, ("index",)), ("index",))
    return attrs.select("index", F.explode("attrs").alias("key", "value"))


DAILY_SQL = (
    q.with_(q.OBS)
    + """, daily AS (SELECT lat, lon, variable, CAST(ts AS DATE) AS time, count(value) AS n,
      CASE variable WHEN 'tasmax' THEN max(value) WHEN 'tasmin' THEN min(value) WHEN 'pr' THEN sum(value)
        ELSE avg(value) END AS value FROM obs GROUP BY 1, 2, 3, 4)
    SELECT lat, lon, variable, CAST(time AS VARCHAR) AS time, n, round(value, 6) AS value FROM daily"""
)


@query("a26_daily_statistics", DAILY_SQL)
def a26(spark, sf):
    obs = tables.sub_daily(spark, tables.table(spark, sf, "events"))
    out = resample.daily_statistics(obs)
    return out.select(*CELL, "variable", text("time").alias("time"), "n", r6("value").alias("value"))


@query(
    "a27_dataset_summary",
    q.with_(q.GRID)
    + """, v AS (SELECT time, lat, lon, CASE WHEN tasmax > 40 THEN NULL ELSE tasmax END AS v FROM grid)
    SELECT count(DISTINCT time) * count(DISTINCT lat) * count(DISTINCT lon) AS total, count(v) AS valid,
      count(DISTINCT time) * count(DISTINCT lat) * count(DISTINCT lon) - count(v) AS missing,
      round(count(v) / (count(DISTINCT time) * count(DISTINCT lat) * count(DISTINCT lon)) * 100, 6) AS pct_valid,
      min(v) AS min, max(v) AS max FROM v""",
)
def a27(spark, sf):
    grid = tables.grid_daily(spark, sf).withColumn("v", F.when(F.col("tasmax") <= 40, F.col("tasmax")))
    return quality.dataset_summary(grid, "v").withColumn("pct_valid", r6("pct_valid"))


@query(
    "a28_step_summary",
    q.with_(q.GRID)
    + """, ax AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS position FROM (SELECT DISTINCT time FROM grid)),
    n AS (SELECT count(*) AS n FROM ax), box AS (SELECT count(DISTINCT lat) * count(DISTINCT lon) AS total FROM grid),
    s AS (SELECT time, position FROM ax, n WHERE position IN (0, n.n // 2, n.n - 1))
    SELECT CAST(time AS VARCHAR) AS time, position, total, count(tas) AS valid, total - count(tas) AS missing,
      round(count(tas) / total * 100, 6) AS pct_valid, round(min(tas), 6) AS min, round(max(tas), 6) AS max,
      round(avg(tas), 6) AS mean, round(stddev_pop(tas), 6) AS std
    FROM grid JOIN s USING (time), box GROUP BY 1, 2, 3""",
)
def a28(spark, sf):
    grid = tables.grid_daily(spark, sf)
    out = quality.step_summary(grid, "tas", quality.first_middle_last(grid))
    return _rounded_steps(out)


def _rounded_steps(df):
    stats = [r6(c).alias(c) for c in ("pct_valid", "min", "max", "mean", "std")]
    return df.select(
        text("time").alias("time"), F.col("position").cast("bigint").alias("position"), "total", "valid", "missing", *stats
    )


@query(
    "a28_random_steps",
    q.with_(q.GRID)
    + """, ax AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS position FROM (SELECT DISTINCT time FROM grid)),
    box AS (SELECT count(DISTINCT lat) * count(DISTINCT lon) AS total FROM grid),
    s AS (SELECT time, position FROM ax ORDER BY md5('7:' || CAST(time AS VARCHAR)), time LIMIT 5)
    SELECT CAST(time AS VARCHAR) AS time, position, total, count(tas) AS valid, total - count(tas) AS missing,
      round(count(tas) / total * 100, 6) AS pct_valid, round(min(tas), 6) AS min, round(max(tas), 6) AS max,
      round(avg(tas), 6) AS mean, round(stddev_pop(tas), 6) AS std
    FROM grid JOIN s USING (time), box GROUP BY 1, 2, 3""",
)
def a28_random(spark, sf):
    grid = tables.grid_daily(spark, sf)
    return _rounded_steps(quality.step_summary(grid, "tas", quality.random_steps(grid, 5, seed=7)))


def _short(start, needed, test):
    return (
        q.with_(q.GRID)
        + f""", n AS (SELECT {start} AS p, count(DISTINCT time) AS n FROM grid GROUP BY 1)
        SELECT lat, lon, CAST({start} AS VARCHAR) AS time, CAST(count(*) FILTER (WHERE {test}) AS DOUBLE) AS value
        FROM grid JOIN n ON p = {start} WHERE n.n >= {needed} GROUP BY 1, 2, 3"""
    )


def _short_index(spark, sf, name, freq):
    grid = tables.grid_daily(spark, sf)
    out = indices.compute_index(grid, indices.get_index(name).index, freq)
    out = completeness.keep_complete(out, completeness.complete_periods(grid, (freq,)), freq)
    return out.select(*CELL, text("time").alias("time"), "value")


@query("a9_tx30_weekly", _short("CAST(date_trunc('week', time) AS DATE)", 5.6, "tasmax > 30"))
def a9_weekly(spark, sf):
    return _short_index(spark, sf, "tx30", "W-MON")


@query("a9_fd_daily", _short("time", 0.8, "tasmin < 0"))
def a9_daily(spark, sf):
    return _short_index(spark, sf, "fd", "D")


@query(
    "a12_monthly_input",
    q.with_(q.GRID)
    + """, m AS (SELECT DISTINCT CAST(date_trunc('month', time) AS DATE) AS time FROM grid),
    p AS (SELECT 'YS' AS freq, CAST(date_trunc('year', time) AS DATE) AS s, count(*) AS n FROM m GROUP BY 2 HAVING count(*) >= 9.6
      UNION ALL SELECT 'QS-DEC', CAST(date_trunc('quarter', time + INTERVAL 1 MONTH) - INTERVAL 1 MONTH AS DATE), count(*) FROM m GROUP BY 2 HAVING count(*) >= 2.4
      UNION ALL SELECT 'MS', time, 1 FROM m)
    SELECT freq, CAST(s AS VARCHAR) AS time FROM p""",
)
def a12_monthly(spark, sf):
    grid = tables.grid_daily(spark, sf)
    months = resample.resample(grid, MONTHLY, {"pr": F.sum("pr")}, CELL)
    found = completeness.complete_periods(months, STANDARD_FREQS, sample=completeness.require_frequency(months))
    return found.select("freq", text("time").alias("time"))


@query(
    "a29_suspicious_values",
    q.with_(q.GRID)
    + """SELECT CAST(bool_or(isinf(tasmin)) AS BIGINT) AS has_inf, CAST(bool_or(tasmin = 0) AS BIGINT) AS has_zero,
      CAST(bool_or(tasmin < 0) AS BIGINT) AS has_negative FROM grid""",
)
def a29(spark, sf):
    out = quality.suspicious_values(tables.grid_daily(spark, sf), "tasmin")
    return out.select(*[flag(c).alias(c) for c in out.columns])


@query(
    "a30_point_series",
    q.with_(q.GRID)
    + """, p AS (SELECT * FROM grid
      WHERE lat = (SELECT lat FROM grid ORDER BY abs(lat - 30.375), lat DESC LIMIT 1)
        AND lon = (SELECT lon FROM grid ORDER BY abs(lon + 29.6), lon DESC LIMIT 1)),
    v AS (SELECT lat, lon, CASE WHEN tas > 30 THEN NULL ELSE tas END AS tas FROM p)
    SELECT lat, lon, count(*) AS n, count(*) - count(tas) AS missing, round(avg(tas), 6) AS mean,
      round(stddev_pop(tas), 6) AS std, round(min(tas), 6) AS min, round(max(tas), 6) AS max,
      round(median(tas), 6) AS median FROM v GROUP BY 1, 2""",
)
def a30(spark, sf):
    point = quality.nearest_cell(tables.grid_daily(spark, sf), 30.375, -29.6)
    series = point.withColumn("tas", F.when(F.col("tas") <= 30, F.col("tas")))
    out = quality.series_summary(series, "tas")
    return out.select(
        *CELL, "n", "missing", *[r6(c).alias(c) for c in ("mean", "std", "min", "max", "median")]
    )


@query(
    "a31_linear_trend",
    q.with_(q.GRID)
    + f""", m AS (SELECT lat, lon, {q.month()} AS time, avg(tas) AS v FROM grid GROUP BY 1, 2, 3),
    x AS (SELECT lat, lon, v, (time - min(time) OVER (PARTITION BY lat, lon)) / CAST(365.25 AS DOUBLE) AS x FROM m)
    SELECT lat, lon, count(*) AS n, round(regr_slope(v, x), 6) AS slope, round(regr_intercept(v, x), 6) AS intercept,
      round(corr(v, x), 6) AS r FROM x GROUP BY 1, 2""",
)
def a31(spark, sf):
    monthly = resample.resample(tables.grid_daily(spark, sf), MONTHLY, {"v": F.avg("tas")})
    out = quality.linear_trend(monthly, "v")
    return out.select(*CELL, "n", *[r6(c).alias(c) for c in ("slope", "intercept", "r")])


# Student's t with whole degrees of freedom as a finite series, another way than the engine's.
_P_SERIES = """CASE WHEN nu % 2 = 0 THEN abs(r) * list_sum(list_transform(range(0, nu // 2), lambda k:
      exp(coalesce(list_sum(list_transform(range(1, k + 1), lambda j: ln((2 * j - 1) / (2.0 * j)))), 0) + k * ln(1 - r * r))))
    ELSE 2 / pi() * (asin(abs(r)) + abs(r) * sqrt(1 - r * r) * coalesce(list_sum(list_transform(range(0, (nu - 1) // 2), lambda k:
      exp(coalesce(list_sum(list_transform(range(1, k + 1), lambda j: ln(2.0 * j / (2 * j + 1)))), 0) + k * ln(1 - r * r)))), 0)) END"""


@query(
    "a31_trend_significance",
    q.with_(q.GRID)
    + f""", m AS (SELECT lat, lon, {q.month()} AS time, avg(tas) AS v FROM grid GROUP BY 1, 2, 3),
    x AS (SELECT lat, lon, v, (time - min(time) OVER (PARTITION BY lat, lon)) / CAST(365.25 AS DOUBLE) AS x FROM m),
    f AS (SELECT lat, lon, count(*) AS n, count(*) - 2 AS nu, corr(v, x) AS r,
      sqrt(greatest(regr_syy(v, x) - regr_slope(v, x) * regr_sxy(v, x), 0) / regr_sxx(v, x) / (count(*) - 2)) AS se
      FROM x GROUP BY 1, 2 HAVING count(*) > 2)
    SELECT lat, lon, n, round(1 - {_P_SERIES}, 6) AS p_value, round(se, 6) AS std_err FROM f""",
)
def a31_significance(spark, sf):
    monthly = resample.resample(tables.grid_daily(spark, sf), MONTHLY, {"v": F.avg("tas")})
    out = quality.linear_trend(monthly, "v").where(F.col("n") > 2)
    return out.select(*CELL, "n", r6("p_value").alias("p_value"), r6("std_err").alias("std_err"))


@query(
    "a32_decade_distribution",
    q.with_(q.GRID)
    + """SELECT lat, lon, (year(time) // 10) * 10 AS decade, count(*) AS n, round(min(tas), 6) AS min,
      round(quantile_cont(tas, 0.25), 6) AS q25, round(quantile_cont(tas, 0.5), 6) AS q50,
      round(quantile_cont(tas, 0.75), 6) AS q75, round(max(tas), 6) AS max, round(avg(tas), 6) AS mean,
      round(stddev_pop(tas), 6) AS std FROM grid GROUP BY 1, 2, 3""",
)
def a32(spark, sf):
    out = quality.decade_distribution(tables.grid_daily(spark, sf), "tas")
    stats = ("min", "q25", "q50", "q75", "max", "mean", "std")
    return out.select(
        *CELL, F.col("decade").cast("bigint").alias("decade"), "n", *[r6(c).alias(c) for c in stats]
    )


@query(
    "a33_dimension_changes",
    """WITH old AS (SELECT CAST(l_shipdate AS DATE) AS time, l_suppkey // 6 AS region FROM lineitem
        WHERE l_shipdate < TIMESTAMP '2000-01-01' AND l_suppkey // 6 <> 3),
      new AS (SELECT CAST(l_shipdate AS DATE) AS time, l_suppkey // 6 AS region FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1995-03-01' AND l_suppkey // 6 <> 5),
      o AS (SELECT count(DISTINCT time) AS t, count(DISTINCT region) AS r FROM old),
      n AS (SELECT count(DISTINCT time) AS t, count(DISTINCT region) AS r FROM new)
    SELECT 'time' AS dim, o.t AS old_size, n.t AS new_size, CASE WHEN o.t = n.t THEN 'Match' ELSE 'CHANGED' END AS status FROM o, n
    UNION ALL SELECT 'region', o.r, n.r, CASE WHEN o.r = n.r THEN 'Match' ELSE 'CHANGED' END FROM o, n""",
)
def a33(spark, sf):
    return compare.dimension_changes(*versions(spark, sf), ("time", "region"))


_OUTPUTS = """outputs AS (SELECT 'i' || p_size AS index, 'NUTS-' || (p_partkey % 4) AS region_set,
    'd' || p_partkey AS dataset, p_partkey AS k, p_size FROM part),
  meta AS (SELECT dataset, CASE WHEN p_size % 3 = 0 AND k % 97 = 1 THEN 'MS, YS' ELSE 'MS, QS-DEC, YS' END AS used
    FROM outputs WHERE p_size % 5 <> 0 OR k % 89 <> 2)"""


@query(
    "a34_updatable_outputs",
    q.with_(_OUTPUTS)
    + """SELECT index, CAST(bool_and(coalesce(list_contains(string_split(used, ', '), 'QS-DEC'), false)) AS BIGINT) AS updatable
    FROM outputs LEFT JOIN meta USING (dataset) GROUP BY 1""",
)
def a34(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size")
    outputs = tables.table(spark, sf, "part").select(
        F.concat(F.lit("i"), text("p_size")).alias("index"),
        F.concat(F.lit("NUTS-"), text(k % 4)).alias("region_set"),
        F.concat(F.lit("d"), text(k)).alias("dataset"),
        "p_partkey",
        "p_size",
    )
    used = F.when((size % 3 == 0) & (k % 97 == 1), "MS, YS").otherwise("MS, QS-DEC, YS")
    meta = outputs.where((size % 5 != 0) | (k % 89 != 2)).select(
        "dataset", F.create_map(F.lit("frequencies_used"), used).alias("attrs")
    )
    out = incremental.updatable(outputs.select("index", "region_set", "dataset"), meta, STANDARD_FREQS)
    return out.withColumn("updatable", flag("updatable"))


@query(
    "a35_date_range",
    q.with_(q.GRID)
    + """SELECT lat, lon, CAST(min(time) AS VARCHAR) || '/' || CAST(max(time) AS VARCHAR) AS valid FROM grid GROUP BY 1, 2""",
)
def a35(spark, sf):
    span = F.concat_ws("/", text(F.min("time")), text(F.max("time"))).alias("valid")
    return tables.grid_daily(spark, sf).groupBy(*CELL).agg(span)
