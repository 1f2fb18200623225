"""Joins: cells to regions, observations to percentiles, old to new."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import CELL
from ..model import MONTHLY, SEASONAL, PercentileSpec
from ..operators import combine, compare, completeness, indices, percentiles, regions, resample
from ..plans import incremental
from ..sources import manifest, naming, store, tables
from . import SQL, query
from . import sql as q
from .common import cells, flag, r6, text, xwalk


@query(
    "j1_cells_in_polygons",
    q.with_(q.CELLS, q.REGIONS, q.INSIDE) + "SELECT region_set, region, lat, lon FROM inside",
)
def j1(spark, sf):
    return regions.cells_inside(cells(spark, sf), tables.regions(spark, sf))


@query(
    "j2_grid_to_crosswalk",
    q.with_(q.GRID, q.XWALK)
    + """, daily AS (SELECT region_set, region, time, sum(tasmax * w) / sum(w) AS tasmax
      FROM grid JOIN xwalk USING (lat, lon) WHERE filled = 0 GROUP BY 1, 2, 3)
    SELECT region_set, region, count(*) AS days, round(avg(tasmax), 6) AS mean, round(max(tasmax), 6) AS top
    FROM daily GROUP BY 1, 2""",
)
def j2(spark, sf):
    inside = xwalk(spark, sf).where(~F.col("filled"))
    daily = regions.aggregate_days(tables.grid_daily(spark, sf), inside, ["tasmax"])
    return daily.groupBy("region_set", "region").agg(
        F.count("*").alias("days"), r6(F.avg("tasmax")).alias("mean"), r6(F.max("tasmax")).alias("top")
    )


@query("j2_regional_sums_by_tile", SQL["j2_grid_to_crosswalk"])
def j2_tiles(spark, sf):
    """As for a crosswalk beyond the broadcast limit: both sides dealt by map tile."""
    inside = xwalk(spark, sf).where(~F.col("filled"))
    daily = regions.aggregate_regions(tables.grid_daily(spark, sf), inside, ["tasmax"], tile=2.0)
    return daily.groupBy("region_set", "region").agg(
        F.count("*").alias("days"), r6(F.avg("tasmax")).alias("mean"), r6(F.max("tasmax")).alias("top")
    )


@query(
    "j3_regions_without_cells",
    q.with_(q.CELLS, q.REGIONS, q.INSIDE, q.NEAREST) + "SELECT region_set, region FROM empty_regions",
)
def j3(spark, sf):
    outlines = tables.regions(spark, sf)
    inside = regions.cells_inside(cells(spark, sf), outlines)
    return regions.empty_regions(outlines, inside).select("region_set", "region")


@query(
    "j4_nearest_cell",
    q.with_(q.CELLS, q.REGIONS, q.INSIDE, q.NEAREST) + "SELECT region_set, region, lat, lon FROM nearest",
)
def j4(spark, sf):
    c, outlines = cells(spark, sf), tables.regions(spark, sf)
    return regions.nearest_cells(regions.empty_regions(outlines, regions.cells_inside(c, outlines)), c)


_PERIOD_NAME = {
    "MS": "strftime(time, '%b')",
    "QS-DEC": f"CASE month({q.season()}) WHEN 12 THEN 'DecFeb' WHEN 3 THEN 'MarMay' WHEN 6 THEN 'JunAug' ELSE 'SepNov' END",
    "YS": "'Annual'",
}


def _above_percentile_sql(freq: str) -> str:
    return q.with_(q.GRID) + f""", k AS (SELECT *, {_PERIOD_NAME[freq]} AS period FROM grid),
    p AS (SELECT lat, lon, period, quantile_cont(tasmax, 0.9) AS q FROM k GROUP BY 1, 2, 3)
    SELECT k.lat, k.lon, CAST({q.start(freq)} AS VARCHAR) AS time,
      CAST(count(*) FILTER (WHERE tasmax > q) AS BIGINT) AS days_above, CAST(count(*) AS BIGINT) AS n
    FROM k LEFT JOIN p USING (lat, lon, period) GROUP BY 1, 2, 3"""


def _above_percentile(spark, sf, freq):
    grid = tables.grid_daily(spark, sf).select("time", *CELL, "tasmax")
    pct = percentiles.reference_percentile(grid, "tasmax", PercentileSpec(90), freq)
    joined = percentiles.join_period_percentile(grid, pct, freq)
    out = resample.resample(
        joined, freq, {"days_above": F.count_if(F.col("tasmax") > F.col("q")), "n": F.count("*")}
    )
    return out.withColumn("time", text("time"))


@query("j5_percentile_by_month", _above_percentile_sql("MS"))
def j5_month(spark, sf):
    return _above_percentile(spark, sf, MONTHLY)


@query("j5_percentile_by_season", _above_percentile_sql("QS-DEC"))
def j5_season(spark, sf):
    return _above_percentile(spark, sf, SEASONAL)


@query("j5_percentile_by_year", _above_percentile_sql("YS"))
def j5_year(spark, sf):
    return _above_percentile(spark, sf, "YS")


# Percentile of a centred six-day window, pooled over years, plotting position 1/3.
DOY = """span AS (SELECT min(time) AS t0, max(time) AS t1, max(dayofyear(time)) AS longest FROM grid),
spread AS (
  SELECT lat, lon, CAST(time + to_days(CAST(s AS INTEGER)) AS DATE) AS day, pr AS v
  FROM grid, unnest(range(-2, 4)) AS t(s) WHERE pr IS NOT NULL),
pool AS (
  SELECT lat, lon, dayofyear(day) AS doy, list_sort(list(v)) AS vs, CAST(count(*) AS DOUBLE) AS n
  FROM spread, span WHERE day BETWEEN t0 AND t1 GROUP BY 1, 2, 3),
pos AS (
  SELECT *, greatest(1.0, least(n * CAST({p} AS DOUBLE) + CAST({c} AS DOUBLE), n)) AS h FROM pool),
raw AS (
  SELECT lat, lon, doy, vs[CAST(floor(h) AS INT)]
    + (h - floor(h)) * (vs[CAST(least(floor(h) + 1, n) AS INT)] - vs[CAST(floor(h) AS INT)]) AS q FROM pos)""".format(
    p=0.95, c=repr(1 / 3 + 0.95 * (1 - 1 / 3 - 1 / 3))
)

STRETCH = """short AS (SELECT raw.* FROM raw, span WHERE longest < 366 OR doy < 366),
pct AS (
  SELECT lat, lon, doy, CASE WHEN longest < 366 OR doy = 1 THEN q
    ELSE lag(q) OVER (PARTITION BY lat, lon ORDER BY doy) * (doy - 1) / 365 + q * (366 - doy) / 365 END AS q
  FROM short, span
  UNION ALL SELECT lat, lon, 366, q FROM short, span WHERE longest = 366 AND doy = 365)"""


@query(
    "j6_percentile_by_day_of_year",
    q.with_(q.GRID, DOY, STRETCH)
    + f"""SELECT lat, lon, CAST({q.year()} AS VARCHAR) AS time, count(*) FILTER (WHERE pr > q) AS days_above
    FROM (SELECT g.*, p.q FROM grid g LEFT JOIN pct p ON g.lat = p.lat AND g.lon = p.lon
          AND dayofyear(g.time) = p.doy) GROUP BY 1, 2, 3""",
)
def j6(spark, sf):
    grid = tables.grid_daily(spark, sf).select("time", *CELL, "pr")
    joined = percentiles.join_doy_percentile(grid, percentiles.day_of_year_table(grid, "pr", 95), "pr")
    out = resample.resample_cells(joined, "YS", {"days_above": F.count_if(F.col("pr") > F.col("q"))})
    return out.select(*CELL, text("time").alias("time"), "days_above")


@query(
    "j7_keep_complete_periods",
    q.with_(q.GRID, q.periods(), q.COMPLETE)
    + f"""SELECT lat, lon, CAST(m.time AS VARCHAR) AS time, m.tx30 FROM
      (SELECT lat, lon, {q.season()} AS time, CAST(count(*) FILTER (WHERE tasmax > 30) AS DOUBLE) AS tx30
       FROM grid GROUP BY 1, 2, 3) m
      WHERE EXISTS (SELECT 1 FROM complete c WHERE c.freq = 'QS-DEC' AND c.time = m.time)""",
)
def j7(spark, sf):
    grid = tables.grid_daily(spark, sf)
    index = indices.compute_index(grid, indices.get_index("tx30").index, SEASONAL)
    kept = completeness.keep_complete(index, completeness.complete_periods(grid, (SEASONAL,)), SEASONAL)
    return kept.select(*CELL, text("time").alias("time"), F.col("value").alias("tx30"))


_LABELLED = f"""lab AS (
  SELECT lat, {q.month()} AS m, strftime({q.month()}, '%b') AS time_filter, sum(pr) AS pr
  FROM grid WHERE month(time) <= 8 GROUP BY 1, 2, 3)"""


@query(
    "j8_align_to_stored_labels",
    q.with_(q.GRID, _LABELLED)
    + """, stored AS (SELECT DISTINCT strftime(o_orderdate, '%b') AS time_filter FROM orders
      WHERE month(o_orderdate) >= 5)
    SELECT s.time_filter, CAST(count(m) AS BIGINT) AS n, round(sum(pr), 6) AS pr
    FROM stored s LEFT JOIN lab USING (time_filter) GROUP BY 1""",
)
def j8(spark, sf):
    grid = tables.grid_daily(spark, sf).where(F.month("time") <= 8)
    monthly = resample.resample(grid, MONTHLY, {"pr": F.sum("pr")}, ("lat",))
    new = combine.label_periods(monthly, MONTHLY)
    orders = tables.table(spark, sf, "orders").where(F.month("o_orderdate") >= 5)
    stored = orders.select(F.date_format("o_orderdate", "MMM").alias("time_filter"))
    aligned = store.align_labels(new, stored, "time_filter")
    return aligned.groupBy("time_filter").agg(F.count("period").alias("n"), r6(F.sum("pr")).alias("pr"))


_FILES = """want AS (
  SELECT '/data/ERA5/tas/None/' || strftime(o_orderdate, '%Y') || '/tas_None_ERA5_' || strftime(o_orderdate, '%Y%m%d') || '.nc' AS file
  FROM (SELECT DISTINCT o_orderdate FROM orders)),
have AS (
  SELECT '/data/ERA5/tas/None/' || strftime(l_shipdate, '%Y') || '/tas_None_ERA5_' || strftime(l_shipdate, '%Y%m%d') || '.nc' AS file,
    bool_or(l_returnflag = 'R' AND l_linenumber >= 5) AS valid
  FROM lineitem GROUP BY 1)"""


@query(
    "j9_missing_files",
    q.with_(_FILES) + "SELECT file FROM want w WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.file = w.file AND valid)",
)
def j9(spark, sf):
    def path(date):
        lit = F.lit
        return naming.file_path(
            lit("/data"), lit("ERA5"), lit("tas"), lit(None).cast("string"), date, lit("daily"), lit("nc")
        )

    orders = tables.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    items = tables.table(spark, sf, "lineitem")
    good = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") >= 5)
    days = items.groupBy(F.to_date("l_shipdate").alias("d")).agg(F.bool_or(good).alias("valid"))
    return manifest.missing_files(
        orders.select(path(F.col("d")).alias("file")), days.select(path(F.col("d")).alias("file"), "valid")
    )


@query(
    "j10_index_lookup",
    q.with_(q.GRID)
    + """, cfg AS (SELECT * FROM (VALUES ('tx30','tasmax','days'), ('tx35','tasmax','days'), ('tx40','tasmax','days'),
      ('tr20','tasmin','days'), ('tr25','tasmin','days'), ('fd','tasmin','days'), ('r20mm','pr','days'),
      ('r1mm','pr','days'), ('r95ptot','pr','1')) v(index, variable, units)),
    long AS (SELECT 'tasmax' AS variable, tasmax AS v FROM grid UNION ALL SELECT 'tasmin', tasmin FROM grid
      UNION ALL SELECT 'pr', pr FROM grid UNION ALL SELECT 'tas', tas FROM grid),
    stat AS (SELECT variable, count(*) AS n, max(v) AS top FROM long GROUP BY 1)
    SELECT index, variable, units, CAST(n AS BIGINT) AS n, round(top, 6) AS top FROM stat JOIN cfg USING (variable)""",
)
def j10(spark, sf):
    names = ["tasmax", "tasmin", "pr", "tas"]
    entries = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("v")) for v in names])
    long = tables.grid_daily(spark, sf).select(F.explode(entries).alias("e")).select("e.*")
    stats = long.groupBy("variable").agg(F.count("*").alias("n"), F.max("v").alias("top"))
    lookup = indices.index_table(spark).select("index", "variable", "units")
    return stats.join(F.broadcast(lookup), "variable").select("index", "variable", "units", "n", r6("top").alias("top"))


_VERSIONS = """old AS (SELECT 'S' || (l_suppkey // 6) AS region, CAST(l_shipdate AS DATE) AS time, sum(l_quantity) AS tas
    FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01' AND l_suppkey // 6 <> 3 GROUP BY 1, 2),
  new AS (SELECT 'S' || (l_suppkey // 6) AS region, CAST(l_shipdate AS DATE) AS time,
      sum(l_quantity) + CASE WHEN day(l_shipdate) = 13 THEN 1 ELSE 0 END AS tas
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-03-01' AND l_suppkey // 6 <> 5
    GROUP BY 1, 2, l_shipdate)"""


def versions(spark, sf):
    """An old and a new regional store that overlap in time and regions."""
    items = tables.table(spark, sf, "lineitem")
    cell = F.floor(F.col("l_suppkey") / 6)
    day = F.to_date("l_shipdate").alias("time")
    region = F.concat(F.lit("S"), cell.cast("string")).alias("region")
    old = (
        items.where((F.col("l_shipdate") < "2000-01-01") & (cell != 3))
        .groupBy(region, day)
        .agg(F.sum("l_quantity").alias("tas"))
    )
    new = (
        items.where((F.col("l_shipdate") >= "1995-03-01") & (cell != 5))
        .groupBy(region, day)
        .agg(F.sum("l_quantity").alias("tas"))
        .withColumn("tas", F.col("tas") + F.when(F.dayofmonth("time") == 13, 1).otherwise(0))
    )
    return old, new


@query(
    "j11_compare_versions",
    q.with_(_VERSIONS)
    + """SELECT count(*) AS common, count(*) FILTER (WHERE abs(o.tas - n.tas) <= 1e-8 + 1e-5 * abs(n.tas)) AS agree,
      max(abs(o.tas - n.tas)) AS max_abs_diff, CAST(0 AS BIGINT) AS identical
    FROM old o JOIN new n USING (region, time)""",
)
def j11(spark, sf):
    out = compare.value_differences(*versions(spark, sf), "tas", ("region", "time"))
    return out.withColumn("identical", flag("identical"))


_ATTRS = """a AS (SELECT 'd' || p_partkey AS dataset, unnest([
      {'k': 'dc:title', 'v': p_name}, {'k': 'dcterms:valid', 'v': p_size::VARCHAR},
      {'k': 'brand', 'v': CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END}]) AS e FROM part),
  b AS (SELECT 'd' || p_partkey AS dataset, unnest([
      {'k': 'dc:title', 'v': p_name}, {'k': 'dcterms:valid', 'v': (p_size + p_partkey % 2)::VARCHAR},
      {'k': 'kind', 'v': p_type}]) AS e FROM part WHERE p_partkey % 7 <> 0)"""


def attribute_versions(spark, sf):
    part = tables.table(spark, sf, "part")
    k = F.col("p_partkey")
    dataset = F.concat(F.lit("d"), k.cast("string")).alias("dataset")
    lit, size = F.lit, F.col("p_size")
    old = part.select(
        dataset,
        F.create_map(
            lit("dc:title"), "p_name", lit("dcterms:valid"), size.cast("string"),
            lit("brand"), F.when(k % 3 != 0, F.col("p_brand")),
        ).alias("attrs"),
    )
    new = part.where(k % 7 != 0).select(
        dataset,
        F.create_map(
            lit("dc:title"), "p_name", lit("dcterms:valid"), (size + k % 2).cast("string"), lit("kind"), "p_type"
        ).alias("attrs"),
    )
    return old, new


@query(
    "j12_attribute_changes",
    q.with_(_ATTRS)
    + """SELECT coalesce(a.dataset, b.dataset) AS dataset, coalesce(a.e.k, b.e.k) AS key,
      CASE WHEN a.e.v IS NULL AND b.e.v IS NULL THEN 'Match' WHEN a.e.v IS NULL THEN 'ADDED'
        WHEN b.e.v IS NULL THEN 'REMOVED' WHEN a.e.v <> b.e.v THEN 'CHANGED' ELSE 'Match' END AS status,
      a.e.v AS old_value, b.e.v AS new_value
    FROM a FULL JOIN b ON a.dataset = b.dataset AND a.e.k = b.e.k""",
)
def j12(spark, sf):
    return compare.attribute_changes(*attribute_versions(spark, sf))


@query(
    "j13_first_due_period",
    q.with_(q.GRID, q.periods(), q.COMPLETE)
    + """, ckpt AS (SELECT * FROM (VALUES ('MS', DATE '2000-05-01'), ('YS', DATE '1999-01-01')) v(freq, last_period))
    SELECT freq, CAST(min(time) AS VARCHAR) AS due FROM complete LEFT JOIN ckpt USING (freq)
    WHERE last_period IS NULL OR time > last_period GROUP BY 1""",
)
def j13(spark, sf):
    points = spark.sql(
        "SELECT * FROM VALUES ('MS', DATE '2000-05-01'), ('YS', DATE '1999-01-01') AS t(freq, last_period)"
    )
    complete = completeness.complete_periods(tables.grid_daily(spark, sf), ("MS", "QS-DEC", "YS"))
    return incremental.due_from(complete, points).withColumn("due", text("due"))
