"""Scans, listings, names and manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import CELL
from ..operators import quality
from ..session import scratch_dir
from ..sources import catalog, geojson, manifest, naming, store, tables
from . import query
from . import sql as q
from .common import big, flag, r6, text


@query(
    "s1_read_store_slices",
    q.with_(q.GRID)
    + """, ax AS (SELECT time, row_number() OVER (ORDER BY time) - 1 AS position FROM (SELECT DISTINCT time FROM grid))
    SELECT CAST(time AS VARCHAR) AS time, lat, lon, pr FROM grid JOIN ax USING (time)
    WHERE position >= 100 AND position < 900 AND lat BETWEEN 30.25 AND 30.75""",
)
def s1(spark, sf):
    path = scratch_dir(spark)
    store.write_store(store.with_year(tables.grid_daily(spark, sf)), path, partition_by=["year"])
    out = store.read_store(spark, path, "pr", steps=(100, 900), box={"lat": (30.25, 30.75)})
    return out.select(text("time").alias("time"), *CELL, "pr")


@query(
    "s2_open_projection",
    "SELECT l_suppkey AS s, count(*) AS n, max(l_shipdate)::DATE::VARCHAR AS last FROM lineitem GROUP BY 1",
)
def s2(spark, sf):
    # The path's own scheme, or none, decides the file system.
    df = store.read_store(spark, f"{sf}/lineitem.parquet", ["l_suppkey", "l_shipdate"])
    return df.groupBy(F.col("l_suppkey").alias("s")).agg(
        F.count("*").alias("n"), text(F.to_date(F.max("l_shipdate"))).alias("last")
    )


_PATHS = """paths AS (SELECT 's3://bucket/' || ['tas', 'pr', 'tx30'][(o_orderkey % 3 + 1)::INT] || '_' || o_custkey ||
    ['_ERA5_gridded.zarr', '_ERA5_NUTS-0.zarr', '_ERA5_gridded.nc', '.zarr'][(o_orderkey % 4 + 1)::INT] AS path FROM orders)"""


def _paths(spark, sf):
    k = F.col("o_orderkey")

    def pick(*values):
        return F.array(*[F.lit(v) for v in values])[(k % len(values)).cast("int")]

    return tables.table(spark, sf, "orders").select(
        F.concat(
            F.lit("s3://bucket/"),
            pick("tas", "pr", "tx30"),
            F.lit("_"),
            text("o_custkey"),
            pick("_ERA5_gridded.zarr", "_ERA5_NUTS-0.zarr", "_ERA5_gridded.nc", ".zarr"),
        ).alias("path")
    )


@query(
    "s3_list_by_suffix_and_pattern",
    q.with_(_PATHS)
    + """SELECT path, count(*) AS n FROM paths WHERE path LIKE '%.zarr' AND split_part(path, '/', -1) GLOB 't*_[0-4]*_ERA5_?ridded*' GROUP BY 1""",
)
def s3(spark, sf):
    found = catalog.select_paths(_paths(spark, sf), ".zarr", "t*_[0-4]*_ERA5_?ridded*")
    return found.groupBy("path").agg(F.count("*").alias("n"))


@query(
    "s3_rows_of_listed_files",
    """SELECT 'labels.parquet' AS name, count(*) AS n FROM labels UNION ALL SELECT 'lineitem.parquet', count(*) FROM lineitem
    UNION ALL SELECT 'orders.parquet', count(*) FROM orders""",
)
def s3_folder(spark, sf):
    # A table may be one file or a folder of part files.
    listed = catalog.select_paths(catalog.list_entries(spark, sf, "*.parquet"), pattern="[lo]*")
    counted = listed.join(catalog.rows_of_entries(spark, sf), "path", "left")
    return counted.select(F.col("path").alias("name"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@query(
    "s4_combine_by_coords",
    q.with_(q.GRID, q.PSL)
    + """SELECT lat, lon, count(*) AS n, count(tas) AS n_tas, count(psl) AS n_psl, round(sum(tas), 6) AS tas, round(sum(psl), 2) AS psl
    FROM grid FULL JOIN psl USING (time, lat, lon) GROUP BY 1, 2""",
)
def s4(spark, sf):
    tas = tables.grid_daily(spark, sf).select("time", *CELL, "tas")
    cut = F.col("time") < "1998-07-01"
    merged = store.combine_by_coords([tas.where(cut), tables.second_variable(spark, sf), tas.where(~cut)])
    return merged.groupBy(*CELL).agg(
        F.count("*").alias("n"),
        F.count("tas").alias("n_tas"),
        F.count("psl").alias("n_psl"),
        r6(F.sum("tas")).alias("tas"),
        F.round(F.sum("psl"), 2).alias("psl"),
    )


@query(
    "s5_merge_variables",
    q.with_(q.GRID, q.WIND, q.PSL)
    + """SELECT year(time) AS year, count(*) AS n, count(pr) AS n_pr, count(u10) AS n_wind, count(psl) AS n_psl
    FROM grid FULL JOIN wind USING (time, lat, lon) FULL JOIN psl USING (time, lat, lon) GROUP BY 1""",
)
def s5(spark, sf):
    merged = store.merge_variables(
        [
            tables.grid_daily(spark, sf).select("time", *CELL, "pr"),
            tables.grid_wind(spark, sf),
            tables.second_variable(spark, sf),
        ]
    )
    return merged.groupBy(big(F.year("time")).alias("year")).agg(
        F.count("*").alias("n"),
        F.count("pr").alias("n_pr"),
        F.count("u10").alias("n_wind"),
        F.count("psl").alias("n_psl"),
    )


@query(
    "s6_read_region_polygons",
    q.with_(q.REGIONS)
    + """, p AS (SELECT region, name, country, len(rings) AS rings, unnest(flatten(rings)) AS p FROM regions WHERE region_set = 'NUTS-3')
    SELECT region, name, country, rings, count(*) AS points, round(sum(p.x), 6) AS x, round(sum(p.y), 6) AS y
    FROM p GROUP BY 1, 2, 3, 4""",
)
def s6(spark, sf):
    path = scratch_dir(spark)
    local = tables.regions(spark, sf).where(F.col("region_set") == "NUTS-3")
    geojson.write_features(local, path)
    read = geojson.read_regions(spark, path, "NUTS-3", lines=True)
    points = F.flatten("rings")

    def total(axis_name):
        return F.aggregate(points, F.lit(0.0), lambda acc, p: acc + p[axis_name])

    return read.select(
        "region",
        "name",
        "country",
        big(F.size("rings")).alias("rings"),
        big(F.size(points)).alias("points"),
        r6(total("x")).alias("x"),
        r6(total("y")).alias("y"),
    )


@query(
    "s7_existing_stores",
    """WITH w AS (SELECT DISTINCT 'v' || (c_custkey % 7) || '_' || c_nationkey || '_ERA5_gridded.zarr' AS name FROM customer),
      h AS (SELECT DISTINCT 'v' || (s_suppkey % 7) || '_' || s_nationkey || '_ERA5_gridded.zarr' AS name FROM supplier)
    SELECT name, CASE WHEN h.name IS NULL THEN CAST(0 AS BIGINT) ELSE 1 END AS present FROM w LEFT JOIN h USING (name)""",
)
def s7(spark, sf):
    def name(key, level):
        return naming.grid_store(F.concat(F.lit("v"), text(F.col(key) % 7)), text(level)).alias("name")

    wanted = tables.table(spark, sf, "customer").select(name("c_custkey", "c_nationkey")).distinct()
    listing = tables.table(spark, sf, "supplier").select(name("s_suppkey", "s_nationkey"))
    out = catalog.existing(wanted, listing)
    return out.withColumn("present", flag("present"))


@query(
    "s1_nan_is_missing",
    q.with_(q.GRID)
    + """SELECT lat, lon, count(*) AS n, count(CASE WHEN tasmax <= 25 THEN 1 END) AS present,
      count(CASE WHEN tasmax <= 25 AND tasmax > 20 THEN 1 END) AS warm FROM grid GROUP BY 1, 2""",
)
def s1_nan(spark, sf):
    path = scratch_dir(spark)
    grid = tables.grid_daily(spark, sf).select("time", *CELL, "tasmax")
    nan = F.when(F.col("tasmax") <= 25, F.col("tasmax")).otherwise(F.lit(float("nan")))
    grid.withColumn("tasmax", nan).write.parquet(path)
    stored = store.read_store(spark, path, "tasmax")
    return stored.groupBy(*CELL).agg(
        F.count("*").alias("n"), F.count("tasmax").alias("present"), F.count_if(F.col("tasmax") > 20).alias("warm")
    )


@query(
    "s7_store_kind",
    """WITH f AS (SELECT 'st' || l_suppkey AS store, CASE WHEN l_partkey % 401 = 0 THEN '.zmetadata'
        WHEN l_partkey % 211 = 0 THEN '.zgroup' ELSE 'c/' || l_linenumber END AS file FROM lineitem)
    SELECT store, CASE WHEN bool_or(file = '.zmetadata') THEN 'consolidated' WHEN bool_or(file = '.zgroup') THEN 'unconsolidated'
      ELSE 'none' END AS kind FROM f GROUP BY 1""",
)
def s7_kind(spark, sf):
    k = F.col("l_partkey")
    files = tables.table(spark, sf, "lineitem").select(
        F.concat(F.lit("st"), text("l_suppkey")).alias("store"),
        F.when(k % 401 == 0, ".zmetadata")
        .when(k % 211 == 0, ".zgroup")
        .otherwise(F.concat(F.lit("c/"), text("l_linenumber")))
        .alias("file"),
    )
    return catalog.store_kind(files)


@query(
    "s8_inspect_store",
    q.with_(q.GRID)
    + """SELECT 'time' AS dim, count(DISTINCT time) AS size FROM grid UNION ALL SELECT 'lat', count(DISTINCT lat) FROM grid
      UNION ALL SELECT 'lon', count(DISTINCT lon) FROM grid""",
)
def s8(spark, sf):
    return quality.profile(tables.grid_daily(spark, sf))


@query(
    "s9_parameter_lookup",
    """WITH v AS (SELECT 'ds' || o_custkey AS dataset, 'v' || o_orderkey AS variable,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 2500 END AS param_id FROM orders),
      c AS (SELECT dataset FROM v GROUP BY 1 HAVING count(*) = count(param_id)),
      u AS (SELECT DISTINCT p_size AS id, 'unit ' || p_size AS name FROM part)
    SELECT v.dataset, v.variable, v.param_id, p_name AS long_name, p_brand AS short_name, u.name AS units, p_type AS description
    FROM v JOIN c USING (dataset) JOIN part ON p_partkey = param_id JOIN u ON u.id = p_size""",
)
def s9(spark, sf):
    k = F.col("o_orderkey")
    variables = tables.table(spark, sf, "orders").select(
        F.concat(F.lit("ds"), text("o_custkey")).alias("dataset"),
        F.concat(F.lit("v"), text(k)).alias("variable"),
        F.when(k % 11 != 0, k % 2500).alias("param_id"),
    )
    part = tables.table(spark, sf, "part")
    params = part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("shortname"),
        F.col("p_size").alias("unit_id"),
        F.col("p_type").alias("description"),
    )
    units = part.select(
        F.col("p_size").alias("id"), F.concat(F.lit("unit "), text("p_size")).alias("name")
    ).distinct()
    return catalog.parameter_information(variables, params, units)


_RANGES = """ranges AS (SELECT c_custkey AS id, ['tas', 'tasmax', 'tasmin', 'pr', 'sfcWind'][(c_custkey % 5 + 1)::INT] AS variable,
    CASE WHEN c_custkey % 4 = 0 THEN '500' END AS level,
    CAST(DATE '1995-01-01' + to_days((c_custkey % 900)::INT) AS DATE) AS first,
    CAST(DATE '1995-01-01' + to_days((c_custkey % 900 + c_custkey % 70 * (1 + 20 * (c_custkey % 3)))::INT) AS DATE) AS last,
    ['daily', 'monthly', 'yearly'][(c_custkey % 3 + 1)::INT] AS grain FROM customer)"""


def _ranges(spark, sf):
    k = F.col("c_custkey")

    def pick(*values):
        return F.array(*[F.lit(v) for v in values])[(k % len(values)).cast("int")]

    start = k % 900
    return tables.table(spark, sf, "customer").select(
        pick("tas", "tasmax", "tasmin", "pr", "sfcWind").alias("variable"),
        F.when(k % 4 == 0, "500").alias("level"),
        F.date_add(F.lit("1995-01-01").cast("date"), start.cast("int")).alias("start"),
        F.date_add(
            F.lit("1995-01-01").cast("date"), (start + k % 70 * (1 + 20 * (k % 3))).cast("int")
        ).alias("end"),
        pick("daily", "monthly", "yearly").alias("grain"),
    )


def _manifest_sql(compat: bool) -> str:
    month = "date_trunc('month', first)"
    year = "date_trunc('year', first)"
    if compat:
        month = f"CASE WHEN {month} = first THEN {month} ELSE {month} + INTERVAL 1 MONTH END"
        year = f"CASE WHEN {year} = first THEN {year} ELSE {year} + INTERVAL 1 YEAR END"
    return (
        q.with_(_RANGES)
        + f""", d AS (
      SELECT *, unnest(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 1 DAY))::DATE AS date FROM ranges WHERE grain = 'daily'
      UNION ALL SELECT *, unnest(generate_series(CAST({month} AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 1 MONTH))::DATE FROM ranges WHERE grain = 'monthly'
      UNION ALL SELECT *, unnest(generate_series(CAST({year} AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 1 YEAR))::DATE FROM ranges WHERE grain = 'yearly'),
    n AS (SELECT * FROM (VALUES ('tas', '2m_temperature', 'daily_mean'),
        ('tasmax', 'maximum_2m_temperature_since_previous_post_processing', 'daily_maximum'),
        ('tasmin', 'minimum_2m_temperature_since_previous_post_processing', 'daily_minimum'),
        ('pr', 'total_precipitation', 'daily_sum'),
        ('sfcWind', '10m_u_component_of_neutral_wind,10m_v_component_of_neutral_wind', 'daily_mean')) v(variable, names, stat)),
    t AS (SELECT d.*, names, stat, CASE grain WHEN 'daily' THEN strftime(date, '%Y%m%d')
        WHEN 'monthly' THEN strftime(date, '%d%m%Y') || '-' || strftime(last_day(date), '%d%m%Y')
        ELSE '0101' || year(date) || '-3112' || year(date) END AS token FROM d JOIN n USING (variable))
    SELECT '/data/ERA5/' || variable || '/' || coalesce(level, 'None') || '/' || year(date) || '/' || variable || '_' ||
        coalesce(level, 'None') || '_ERA5_' || token || CASE WHEN variable = 'sfcWind' THEN '.zip' ELSE '.nc' END AS file,
      grain, names, stat AS daily_statistic, CAST(year(date) AS VARCHAR) AS year,
      CASE grain WHEN 'yearly' THEN '01,02,03,04,05,06,07,08,09,10,11,12' ELSE strftime(date, '%m') END AS months,
      CASE grain WHEN 'daily' THEN strftime(date, '%d')
        WHEN 'monthly' THEN array_to_string([lpad(x::VARCHAR, 2, '0') for x in range(1, day(last_day(date)) + 1)], ',')
        ELSE array_to_string([lpad(x::VARCHAR, 2, '0') for x in range(1, 32)], ',') END AS days,
      CAST(greatest(date, first) AS VARCHAR) AS first_day,
      CAST(least(CASE grain WHEN 'daily' THEN date WHEN 'monthly' THEN last_day(date)
        ELSE make_date(year(date), 12, 31) END, last) AS VARCHAR) AS last_day
    FROM t"""
    )


def _manifest(spark, sf, compat):
    out = manifest.requests(_ranges(spark, sf), "/data", compat=compat)
    return out.select(
        "file",
        "grain",
        F.array_join("request_names", ",").alias("names"),
        "daily_statistic",
        "year",
        F.array_join("months", ",").alias("months"),
        F.array_join("days", ",").alias("days"),
        text("first_day").alias("first_day"),
        text("last_day").alias("last_day"),
    )


@query("s10_request_manifest", _manifest_sql(True))
def s10(spark, sf):
    return _manifest(spark, sf, True)


@query("s10_request_manifest_aligned", _manifest_sql(False))
def s10_aligned(spark, sf):
    return _manifest(spark, sf, False)


_ORDER_PATHS = """op AS (SELECT o_orderkey AS id, o_orderkey % 12 AS kind, CAST(o_orderdate AS DATE) AS d,
    'v' || ['tas', 'pr'][(o_orderkey % 2 + 1)::INT] AS variable FROM orders),
  toks AS (SELECT *, CASE WHEN kind IN (1, 4) THEN strftime(d, '01%m%Y') || '-' || strftime(last_day(d), '%d%m%Y')
      WHEN kind IN (2, 5) THEN '0101' || year(d) || '-3112' || year(d)
      WHEN kind = 6 THEN '02' || strftime(d, '%m%Y') || '-05' || strftime(d + INTERVAL 2 MONTH, '%m%Y')
      WHEN kind = 7 THEN year(d) || '-' || (year(d) + 1) WHEN kind = 8 THEN 'whenever'
      ELSE strftime(d, '%Y%m%d') END AS token FROM op),
  full_paths AS (SELECT id, kind, d, variable, token, CASE
      WHEN kind = 9 THEN '/short/' || variable || '.nc'
      WHEN kind = 10 THEN '/data/ERA5/' || variable || '/None/' || year(d) || '/' || 'oops.nc'
      WHEN kind = 11 THEN '/data/ERA5/other/None/' || year(d) || '/' || variable || '_None_ERA5_' || token || '.nc'
      WHEN kind = 3 THEN '/data/ERA5/' || variable || '/None/' || year(d) || '/' || variable || '_None_ERA6_' || token || '.nc'
      WHEN kind IN (4, 5) THEN '/data/ERA5/' || variable || '/500/' || year(d) || '/' || variable || '500_500_ERA5_' || token || '.nc'
      ELSE '/data/ERA5/' || variable || '/None/' || year(d) || '/' || variable || '_None_ERA5_' || token || '.nc' END AS path FROM toks)"""


def _order_paths(spark, sf):
    k = F.col("o_orderkey")
    d, kind = F.col("d"), F.col("kind")
    base = tables.table(spark, sf, "orders").select(
        k.alias("id"),
        (k % 12).alias("kind"),
        F.to_date("o_orderdate").alias("d"),
        F.concat(F.lit("v"), F.when(k % 2 == 0, "tas").otherwise("pr")).alias("variable"),
    )
    year = F.date_format(d, "yyyy")
    token = (
        F.when(kind.isin(1, 4), naming.date_token(d, F.lit("monthly")))
        .when(kind.isin(2, 5), naming.date_token(d, F.lit("yearly")))
        .when(
            kind == 6,
            F.concat(
                F.lit("02"), F.date_format(d, "MMyyyy"), F.lit("-05"), F.date_format(F.add_months(d, 2), "MMyyyy")
            ),
        )
        .when(kind == 7, F.concat(year, F.lit("-"), text(F.year(d) + 1)))
        .when(kind == 8, F.lit("whenever"))
        .otherwise(naming.date_token(d, F.lit("daily")))
    )
    variable = F.col("variable")
    folder = F.when(kind == 11, F.lit("other")).otherwise(variable)
    level = F.when(kind.isin(4, 5), "500").otherwise("None")
    head = F.concat(variable, F.when(kind.isin(4, 5), "500").otherwise(""))
    dataset = F.when(kind == 3, "ERA6").otherwise("ERA5")
    name = F.when(kind == 10, F.lit("oops.nc")).otherwise(
        F.concat(F.concat_ws("_", head, level, dataset, F.col("token")), F.lit(".nc"))
    )
    full = F.concat_ws("/", F.lit("/data/ERA5"), folder, level, year, name)
    path = F.when(kind == 9, F.concat(F.lit("/short/"), variable, F.lit(".nc"))).otherwise(full)
    return base.withColumn("token", token).withColumn("path", path)


@query(
    "s11_parse_paths",
    q.with_(_ORDER_PATHS)
    + """SELECT id, path, CASE WHEN kind = 9 THEN 'path structure' WHEN kind = 10 THEN 'file name structure'
        WHEN kind = 11 THEN 'variable mismatch' WHEN kind = 3 THEN 'dataset mismatch' WHEN kind = 8 THEN 'date format'
        WHEN kind = 7 THEN 'date range format' WHEN kind = 6 THEN 'grain of date range' END AS error,
      CASE WHEN kind IN (1, 4) THEN 'monthly' WHEN kind IN (2, 5) THEN 'yearly' WHEN kind = 0 THEN 'daily' END AS grain,
      CASE WHEN kind IN (0, 1, 2, 4, 5) THEN '/data' END AS directory,
      CASE WHEN kind IN (0, 1, 2, 4, 5) THEN 'ERA5' END AS dataset,
      CASE WHEN kind IN (0, 1, 2, 4, 5) THEN variable END AS variable,
      CASE WHEN kind IN (4, 5) THEN '500' END AS level,
      CASE WHEN kind = 0 THEN CAST(d AS VARCHAR) WHEN kind IN (1, 4) THEN strftime(d, '%Y-%m-01')
        WHEN kind IN (2, 5) THEN year(d) || '-01-01' END AS date FROM full_paths""",
)
def s11(spark, sf):
    parsed = _order_paths(spark, sf).select("id", "path", naming.parse_path(F.col("path")).alias("p"))
    names = ("error", "grain", "directory", "dataset", "variable", "level")
    return parsed.select("id", "path", *[f"p.{n}" for n in names], text("p.date").alias("date"))


@query(
    "s12_build_paths",
    """WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d,
        ['daily', 'monthly', 'yearly'][(o_orderkey % 3 + 1)::INT] AS grain, CASE WHEN o_orderkey % 4 = 1 THEN '850' END AS level FROM orders),
      t AS (SELECT *, coalesce(level, 'None') AS lv, CASE WHEN d IS NULL THEN 'None' WHEN grain = 'daily' THEN strftime(d, '%Y%m%d')
        WHEN grain = 'monthly' THEN strftime(d, '01%m%Y') || '-' || strftime(last_day(d), '%d%m%Y')
        ELSE '0101' || year(d) || '-3112' || year(d) END AS token FROM o)
    SELECT id, '/out/ERA5/tas/' || lv || CASE WHEN d IS NULL THEN '' ELSE '/' || year(d) END || '/tas_' || lv || '_ERA5_' || token || '.nc' AS path FROM t""",
)
def s12(spark, sf):
    k, lit = F.col("o_orderkey"), F.lit
    path = naming.file_path(
        lit("/out"),
        lit("ERA5"),
        lit("tas"),
        F.when(k % 4 == 1, "850"),
        F.when(k % 9 != 4, F.to_date("o_orderdate")),
        F.array(lit("daily"), lit("monthly"), lit("yearly"))[(k % 3).cast("int")],
        lit("nc"),
    )
    return tables.table(spark, sf, "orders").select(k.alias("id"), path.alias("path"))


@query(
    "s13_store_names",
    """SELECT c_custkey AS id, 'v' || (c_custkey % 9) || '_None_ERA5_gridded.zarr' AS grid_name,
      'v' || (c_custkey % 9) || '_' || c_nationkey || '_ERA5_NUTS-' || (c_custkey % 4) || '.zarr' AS region_name FROM customer""",
)
def s13(spark, sf):
    k = F.col("c_custkey")
    variable = F.concat(F.lit("v"), text(k % 9))
    return tables.table(spark, sf, "customer").select(
        k.alias("id"),
        naming.grid_store(variable, F.lit("None")).alias("grid_name"),
        naming.region_store(variable, text("c_nationkey"), F.concat(F.lit("NUTS-"), text(k % 4))).alias("region_name"),
    )
