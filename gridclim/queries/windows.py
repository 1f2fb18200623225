"""Windows, orders and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import CELL
from ..functions import axis, ordered
from ..model import MONTHLY
from ..operators import combine, compare, indices, percentiles, quality, regions, resample, temporal
from ..sources import catalog, store, tables
from . import query
from . import sql as q
from .common import big, cells, flag, r6, text
from .joins import _VERSIONS, versions


@query(
    "w1_centred_moving_mean",
    q.with_(q.GRID)
    + f""", m AS (SELECT lat, lon, {q.month()} AS time, avg(tas) AS v FROM grid GROUP BY 1, 2, 3),
    w AS (SELECT *, count(v) OVER f AS c, avg(v) OVER f AS a FROM m
      WINDOW f AS (PARTITION BY lat, lon ORDER BY time ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING))
    SELECT lat, lon, CAST(time AS VARCHAR) AS time, CASE WHEN c >= 6 THEN round(a, 6) END AS moving_mean FROM w""",
)
def w1(spark, sf):
    monthly = resample.resample(tables.grid_daily(spark, sf), MONTHLY, {"v": F.avg("tas")})
    out = quality.moving_mean(monthly, "v")
    return out.select(*CELL, text("time").alias("time"), r6("moving_mean").alias("moving_mean"))


@query(
    "w2_day_window",
    q.with_(q.GRID)
    + """, s AS (SELECT lat, lon, CAST(time + to_days(CAST(s AS INTEGER)) AS DATE) AS day, pr FROM grid, unnest(range(-2, 4)) AS t(s)),
    b AS (SELECT min(time) AS t0, max(time) AS t1 FROM grid)
    SELECT lat, lon, CAST(dayofyear(day) AS BIGINT) AS doy, count(*) AS n, round(sum(pr), 6) AS total
    FROM s, b WHERE day BETWEEN t0 AND t1 GROUP BY 1, 2, 3""",
)
def w2(spark, sf):
    held = percentiles.day_windows(tables.grid_daily(spark, sf), "pr")
    rows = held.select(*CELL, F.posexplode_outer("windows").alias("position", "vs")).where(F.size("vs") > 0)
    total = F.aggregate("vs", F.lit(0.0), lambda a, v: a + v)
    return rows.select(*CELL, big(F.col("position") + 1).alias("doy"), big(F.size("vs")).alias("n"), r6(total).alias("total"))


@query(
    "w3_repeated_names",
    q.with_(q.REGIONS)
    + """SELECT region_set, name, count(*) AS n FROM regions GROUP BY 1, 2 HAVING count(*) > 1""",
)
def w3(spark, sf):
    named = regions.unique_names(tables.regions(spark, sf)).where(F.col("label") != F.col("name"))
    return named.groupBy("region_set", "name").agg(F.count("*").alias("n"))


@query(
    "w4_step_slice",
    q.with_(q.GRID)
    + """, ax AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS position FROM (SELECT DISTINCT time FROM grid))
    SELECT CAST(time AS VARCHAR) AS time, position, count(*) AS n FROM grid JOIN ax USING (time)
    WHERE position >= 250 AND position < 1250 GROUP BY 1, 2""",
)
def w4(spark, sf):
    grid = tables.grid_daily(spark, sf)
    rows = store.step_slice(grid, grid, 250, 1250).groupBy("time").agg(F.count("*").alias("n"))
    positions = axis.time_positions(grid)
    return rows.join(positions, "time").select(
        text("time").alias("time"), F.col("position").cast("bigint").alias("position"), "n"
    )


@query(
    "w5_step_deltas",
    q.with_(q.GRID)
    + """, d AS (SELECT lat, lon, time - lag(time) OVER (PARTITION BY lat, lon ORDER BY time) AS days FROM grid)
    SELECT lat, lon, CAST(days AS BIGINT) AS days, count(*) AS n FROM d WHERE days IS NOT NULL GROUP BY 1, 2, 3""",
)
def w5(spark, sf):
    deltas = quality.step_deltas(tables.grid_daily(spark, sf)).where(F.col("days").isNotNull())
    return deltas.groupBy(*CELL, F.col("days").cast("bigint").alias("days")).agg(F.count("*").alias("n"))


@query(
    "w6_run_segments",
    """WITH e AS (SELECT event_id, event_type, lag(event_type) OVER (ORDER BY event_id) AS before FROM events),
      s AS (SELECT event_id, event_type, max(CASE WHEN before IS DISTINCT FROM event_type THEN event_id END)
        OVER (ORDER BY event_id) AS segment FROM e)
    SELECT segment, event_type, count(*) AS n FROM s GROUP BY 1, 2""",
)
def w6(spark, sf):
    events = tables.table(spark, sf, "events").select("event_id", "event_type")
    marked = ordered.previous(events, "event_id", "event_type", "before")
    starts = F.when(~F.col("event_type").eqNullSafe(F.col("before")), F.col("event_id"))
    out = ordered.running_max(marked, "event_id", {"segment": (starts, True)})
    return out.groupBy("segment", "event_type").agg(F.count("*").alias("n"))


@query(
    "o1_sorted_axes",
    q.with_(q.GRID)
    + """SELECT 'lat' AS axis, lat AS label, row_number() OVER (ORDER BY lat) - 1 AS position FROM (SELECT DISTINCT lat FROM grid)
    UNION ALL SELECT 'lon', lon, row_number() OVER (ORDER BY lon) - 1 FROM (SELECT DISTINCT lon FROM grid)""",
)
def o1(spark, sf):
    c = cells(spark, sf)

    def one(name):
        axis_labels = c.select(F.sort_array(F.collect_set(name)).alias("a"))
        return axis_labels.select(F.posexplode("a").alias("position", "label")).select(
            F.lit(name).alias("axis"), "label", F.col("position").cast("bigint").alias("position")
        )

    return one("lat").unionByName(one("lon")).orderBy("axis", "label")


@query(
    "o2_index_list",
    q.with_(q.GRID)
    + """, v AS (SELECT 'pr' AS variable, count(pr) AS n FROM grid UNION ALL SELECT 'tasmax', count(tasmax) FROM grid
      UNION ALL SELECT 'tasmin', count(tasmin) FROM grid),
    i AS (SELECT * FROM (VALUES ('fd','tasmin'), ('r1mm','pr'), ('r20mm','pr'), ('r95ptot','pr'), ('tr20','tasmin'),
      ('tr25','tasmin'), ('tx30','tasmax'), ('tx35','tasmax'), ('tx40','tasmax')) t(index, variable))
    SELECT index, variable, n FROM i JOIN v USING (variable) ORDER BY index""",
)
def o2(spark, sf):
    names = ("pr", "tasmax", "tasmin")
    counts = tables.grid_daily(spark, sf).agg(*[F.count(v).alias(v) for v in names])
    entries = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("n")) for v in names])
    long = counts.select(F.explode(entries).alias("e")).select("e.*")
    available = indices.index_table(spark).where(F.col("index").isin(indices.list_indices()))
    return long.join(available, "variable").select("index", "variable", "n").orderBy("index")


@query(
    "o3_first_cell",
    q.with_(q.GRID)
    + """SELECT lat, lon, count(*) AS n, CAST(min(time) AS VARCHAR) AS first FROM grid
    WHERE lat = (SELECT min(lat) FROM grid) AND lon = (SELECT min(lon) FROM grid) GROUP BY 1, 2""",
)
def o3(spark, sf):
    grid = tables.grid_daily(spark, sf)
    first = grid.where(
        (F.col("lat") == axis.scalar(grid, F.min("lat"))) & (F.col("lon") == axis.scalar(grid, F.min("lon")))
    )
    return first.groupBy(*CELL).agg(F.count("*").alias("n"), text(F.min("time")).alias("first"))


@query(
    "o4_latest_time",
    q.with_(q.GRID) + "SELECT lat, lon, CAST(max(time) AS VARCHAR) AS last FROM grid GROUP BY 1, 2",
)
def o4(spark, sf):
    return tables.grid_daily(spark, sf).groupBy(*CELL).agg(text(F.max("time")).alias("last"))


@query(
    "o5_random_steps",
    q.with_(q.GRID)
    + """, ax AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS position FROM (SELECT DISTINCT time FROM grid))
    SELECT CAST(time AS VARCHAR) AS time, position FROM ax ORDER BY md5('11:' || CAST(time AS VARCHAR)), ax.time LIMIT 5""",
)
def o5(spark, sf):
    return quality.random_steps(tables.grid_daily(spark, sf), 5, seed=11).withColumn("time", text("time"))


@query(
    "u1_union_filled_regions",
    q.with_(q.XWALK) + "SELECT region_set, region, CAST(max(filled) AS BIGINT) AS filled, count(*) AS n FROM xwalk GROUP BY 1, 2",
)
def u1(spark, sf):
    table = regions.crosswalk(cells(spark, sf), tables.regions(spark, sf))
    return table.groupBy("region_set", "region").agg(
        flag(F.bool_or("filled")).alias("filled"), F.count("*").alias("n")
    )


@query(
    "u2_season_slices",
    q.with_(q.GRID)
    + """, k AS (SELECT lat, lon, tas, year(time) + CASE WHEN month(time) = 12 THEN 1 ELSE 0 END AS y FROM grid
      WHERE month(time) IN (12, 1, 2)), b AS (SELECT year(min(time)) AS y0, year(max(time)) AS y1 FROM grid)
    SELECT lat, lon, y AS season_year, count(*) AS n, round(avg(tas), 6) AS tas FROM k, b WHERE y BETWEEN y0 AND y1 GROUP BY 1, 2, 3""",
)
def u2(spark, sf):
    rows = temporal.select_time_filter(tables.grid_daily(spark, sf), "12-02")
    return rows.groupBy(*CELL, F.col("season_year").cast("bigint").alias("season_year")).agg(
        F.count("*").alias("n"), r6(F.avg("tas")).alias("tas")
    )


@query(
    "u3_union_period_records",
    q.with_(q.GRID)
    + ", r AS ("
    + q.union(
        *[
            f"SELECT '{f}' AS freq, {q.start(f)} AS time, sum(pr) AS pr FROM grid GROUP BY 2"
            for f in q.STARTS
        ]
    )
    + f""") SELECT CAST({q.reference()} AS VARCHAR) AS time, {q.filter_name()} AS time_filter, round(pr, 5) AS pr FROM r""",
)
def u3(spark, sf):
    grid = tables.grid_daily(spark, sf)
    frames = {f: resample.resample(grid, f, {"pr": F.sum("pr")}, ()) for f in q.STARTS}
    return combine.combine(frames).select(text("time").alias("time"), "time_filter", F.round("pr", 5).alias("pr"))


@query(
    "u4_preserved_steps",
    q.with_(_VERSIONS)
    + """, k AS (SELECT time FROM old INTERSECT SELECT time FROM new)
    SELECT (SELECT count(*) FROM k) AS kept, count(DISTINCT time) AS old_steps,
      CASE WHEN (SELECT count(*) FROM k) = count(DISTINCT time) THEN 'all preserved' ELSE 'data loss' END AS verdict FROM old""",
)
def u4(spark, sf):
    return compare.preserved_steps(*versions(spark, sf))


@query(
    "u5_region_changes",
    q.with_(_VERSIONS)
    + """SELECT region, 'added' AS change FROM (SELECT region FROM new EXCEPT SELECT region FROM old)
    UNION ALL SELECT region, 'removed' FROM (SELECT region FROM old EXCEPT SELECT region FROM new)""",
)
def u5(spark, sf):
    return compare.region_changes(*versions(spark, sf))


@query(
    "u6_missing_names",
    """SELECT 'c' || c_custkey || '.zarr' AS name FROM customer EXCEPT SELECT 'c' || o_custkey || '.zarr' FROM orders
      WHERE o_orderstatus = 'F'""",
)
def u6(spark, sf):
    def name(c):
        return F.concat(F.lit("c"), text(c), F.lit(".zarr")).alias("name")

    wanted = tables.table(spark, sf, "customer").select(name("c_custkey"))
    listing = tables.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(name("o_custkey"))
    return catalog.missing_names(wanted, listing)

