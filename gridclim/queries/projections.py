"""Projections, renames, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import CELL
from ..functions import numeric
from ..model import MONTHLY, STANDARD_FREQS, SeasonWindow, Threshold, YearSpan
from ..operators import canon, indices, temporal, units
from ..sources import catalog, tables
from . import query
from . import sql as q
from .common import flag, r6, text

_UNITS = [
    "Kelvin", "kelvin", "1", "K", "Fahrenheit", "Celsius", "kg kg-1", "degrees Celsius", "degC",
    "m hour**-1", "mm day**-1", "mm/day", "mm", "m", "mm s**-1", "m**3 m**-3", "kg m**-2 day**-1",
    "kg m-2 s-1", "kg m**-2", "kg m-2", "C", "(0 - 1)", "Fraction", "m of water equivalent", "m s**-1",
    "m s-1", "m/s", "km h**-1", "W/m2", "Pa", "knots", "kts", "mph (nautical miles per hour)", "%",
    "W m**-2", "J m**-2",
]
_VARIABLES = ["tas", "pr", "sfcWind", "hurs", "psl", "huss", "rsds", "other"]


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_TARGETS = (
    "targets AS (SELECT * FROM (VALUES ('tas','Celsius'), ('pr','mm'), ('sfcWind','m s-1'), ('hurs','%'), "
    "('psl','hPa'), ('huss','gr kg-1'), ('rsds','W m-2')) v(variable, target))"
)
_FACTORS = """factors AS (SELECT unit, CAST(scale AS DOUBLE) AS scale, CAST(off AS DOUBLE) AS off, out_unit FROM (VALUES
  ('Kelvin', 1, -273.15, 'Celsius'), ('kelvin', 1, -273.15, 'Celsius'), ('1', 1000, 0, 'gr kg-1'),
  ('K', 1, -273.15, 'Celsius'), ('Fahrenheit', 5.0/9, -160.0/9, 'Celsius'), ('Celsius', 1, 0, 'Celsius'),
  ('kg kg-1', 1000, 0, 'gr kg-1'), ('degrees Celsius', 1, 0, 'Celsius'), ('degC', 1, 0, 'Celsius'),
  ('m hour**-1', 24000, 0, 'mm'), ('mm day**-1', 1, 0, 'mm'), ('mm/day', 1, 0, 'mm'), ('mm', 1, 0, 'mm'),
  ('m', 1000, 0, 'mm'), ('mm s**-1', 86400, 0, 'mm'), ('m**3 m**-3', 100, 0, 'kg m-2'),
  ('kg m**-2 day**-1', 1, 0, 'mm'), ('kg m-2 s-1', 86400, 0, 'mm'), ('kg m**-2', 1, 0, 'mm'),
  ('kg m-2', 1, 0, 'mm'), ('C', 1, 0, 'Celsius'), ('(0 - 1)', 100, 0, '%'), ('Fraction', 100, 0, '%'),
  ('m of water equivalent', 1000, 0, 'mm'), ('m s**-1', 1, 0, 'm s-1'), ('m s-1', 1, 0, 'm s-1'),
  ('m/s', 1, 0, 'm s-1'), ('km h**-1', 10.0/36, 0, 'm s-1'), ('W/m2', 1, 0, 'W m-2'), ('Pa', 0.01, 0, 'hPa'),
  ('knots', 0.51, 0, 'm s-1'), ('kts', 0.51, 0, 'm s-1'), ('mph (nautical miles per hour)', 0.51, 0, 'm s-1'),
  ('%', 1, 0, '%'), ('W m**-2', 1, 0, 'W m-2'), ('J m**-2', 1.0/3600, 0, 'W m-2')) v(unit, scale, off, out_unit))"""


def _readings_sql(unit_list: list[str]) -> str:
    return f"""readings AS (SELECT p_partkey AS id, {_sql_list(_VARIABLES)}[(p_partkey % 8 + 1)::INT] AS variable,
      CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE {_sql_list(unit_list)}[(p_partkey % {len(unit_list)} + 1)::INT] END AS unit,
      p_retailprice AS value FROM part)"""


def _readings(spark, sf, unit_list):
    k = F.col("p_partkey")

    def pick(values):
        return F.array(*[F.lit(v) for v in values])[(k % len(values)).cast("int")]

    return tables.table(spark, sf, "part").select(
        k.alias("id"),
        pick(_VARIABLES).alias("variable"),
        F.when(k % 41 != 0, pick(unit_list)).alias("unit"),
        F.col("p_retailprice").alias("value"),
    )


def _convert_sql(unit_list: list[str], factors: str = "factors") -> str:
    return f"""SELECT id, variable, CASE WHEN target IS NOT NULL AND unit <> target AND f.scale IS NOT NULL THEN out_unit
        ELSE r.unit END AS unit,
      round(CASE WHEN target IS NOT NULL AND unit <> target AND f.scale IS NOT NULL THEN value * scale + off ELSE value END, 6) AS value,
      CASE WHEN target IS NULL THEN 'no_target' WHEN r.unit IS NULL THEN 'no_unit' WHEN r.unit = target THEN 'same'
        WHEN f.scale IS NOT NULL THEN 'converted' ELSE 'unknown' END AS status
    FROM readings r LEFT JOIN targets USING (variable) LEFT JOIN {factors} f USING (unit)"""


@query("p1_convert_units", q.with_(_TARGETS, _FACTORS, _readings_sql(_UNITS)) + _convert_sql(_UNITS))
def p1(spark, sf):
    return units.convert_units(_readings(spark, sf, _UNITS)).withColumn("value", r6("value"))


_WITH_UNKNOWN = [*_UNITS, "furlong"]


@query(
    "p1_convert_units_reject",
    q.with_(_TARGETS, _FACTORS, _readings_sql(_WITH_UNKNOWN)) + _convert_sql(_WITH_UNKNOWN),
)
def p1_reject(spark, sf):
    rows = units.convert_units(_readings(spark, sf, _WITH_UNKNOWN), on_unknown="reject")
    return rows.withColumn("value", r6("value"))


@query(
    "p2_conversion_profiles",
    q.with_(
        _TARGETS,
        _FACTORS,
        _readings_sql(_UNITS),
        """prof AS (SELECT f.unit, coalesce(CAST(p.scale AS DOUBLE), f.scale) AS scale, f.off, f.out_unit FROM factors f LEFT JOIN
          (VALUES ('J m**-2', 1.0/86400), ('m', -1000), ('m of water equivalent', -1000)) p(unit, scale) USING (unit))""",
    )
    + _convert_sql(_UNITS, "prof"),
)
def p2(spark, sf):
    rows = units.convert_units(_readings(spark, sf, _UNITS), profile="monthly")
    return rows.withColumn("value", r6("value"))


@query(
    "p3_relabel_units",
    """WITH r AS (SELECT p_partkey AS id, ['tas', 'pr', 'sfcWind', 'hurs'][(p_partkey % 4 + 1)::INT] AS variable,
        ['degC', 'K', 'mm', 'mm day-1', 'm s-1'][(p_partkey % 5 + 1)::INT] AS unit, p_retailprice AS value FROM part),
      e AS (SELECT * FROM (VALUES ('tas', 'degC'), ('pr', 'mm day-1'), ('sfcWind', 'm s-1'), ('hurs', NULL)) v(variable, expected))
    SELECT id, variable, coalesce(expected, unit) AS unit, value, CAST(coalesce(unit <> expected, false) AS BIGINT) AS relabelled
    FROM r JOIN e USING (variable)""",
)
def p3(spark, sf):
    k = F.col("p_partkey")

    def pick(*values):
        return F.array(*[F.lit(v) for v in values])[(k % len(values)).cast("int")]

    rows = tables.table(spark, sf, "part").select(
        k.alias("id"),
        pick("tas", "pr", "sfcWind", "hurs").alias("variable"),
        pick("degC", "K", "mm", "mm day-1", "m s-1").alias("unit"),
        F.col("p_retailprice").alias("value"),
    )
    return units.relabel_units(rows).withColumn("relabelled", flag("relabelled"))


@query(
    "p4_checked_inputs",
    q.with_(q.GRID)
    + f"""SELECT lat, lon, CAST({q.year()} AS VARCHAR) AS time, CAST(count(*) FILTER (WHERE tasmin < 0) AS DOUBLE) AS value
    FROM grid GROUP BY 1, 2, 3""",
)
def p4(spark, sf):
    grid = tables.grid_daily(spark, sf)
    out = indices.compute_index(grid, indices.get_index("fd").index, "YS", units={"tasmin": "Celsius"})
    return out.withColumn("time", text("time"))


_SPEED = "round(sqrt(pow(u10, 2) + pow(v10, 2)), 6)"


@query(
    "p5_wind_speed",
    q.with_(q.WIND) + f"SELECT lat, lon, CAST(time AS VARCHAR) AS time, {_SPEED} AS \"sfcWind\" FROM wind",
)
def p5(spark, sf):
    out = units.wind_from_components(tables.grid_wind(spark, sf))
    return out.select(*CELL, text("time").alias("time"), r6("sfcWind").alias("sfcWind"))


@query(
    "p6_variable_transforms",
    q.with_(q.GRID, q.WIND)
    + """SELECT 'sfcWind' AS variable, count(*) AS n, round(max(sqrt(u10 * u10 + v10 * v10)), 6) AS top FROM wind
      UNION ALL SELECT 'tas', count(*), round(max(tas), 6) FROM grid""",
)
def p6(spark, sf):
    frames = {"sfcWind": tables.grid_wind(spark, sf), "tas": tables.grid_daily(spark, sf)}

    def top(v):
        df = units.apply_transform(frames[v], v)
        return df.agg(F.count("*").alias("n"), r6(F.max(v)).alias("top")).withColumn("variable", F.lit(v))

    return top("sfcWind").unionByName(top("tas"))


@query(
    "p7_rename_variable",
    q.with_(q.GRID) + "SELECT lat, count(pr) AS n, round(sum(pr), 6) AS pr FROM grid GROUP BY 1",
)
def p7(spark, sf):
    raw = tables.grid_daily(spark, sf).select("time", *CELL, F.col("pr").alias("tp"))
    out = canon.rename_variable(raw, "pr")
    return out.groupBy("lat").agg(F.count("pr").alias("n"), r6(F.sum("pr")).alias("pr"))


@query(
    "p8_rename_time",
    q.with_(q.GRID) + "SELECT CAST(time AS VARCHAR) AS time, round(sum(pr), 6) AS pr FROM grid GROUP BY 1",
)
def p8(spark, sf):
    raw = tables.grid_daily(spark, sf).withColumnRenamed("time", "valid_time")
    out = canon.rename_time(raw).groupBy("time").agg(r6(F.sum("pr")).alias("pr"))
    return out.withColumn("time", text("time"))


# Names a source may use for (lat, lon, y, x) and what is left after renaming.
_SCHEMES = {
    "p9a_rotated_with_geographic": {"lat": "latitude", "lon": "longitude", "y": "rlat", "x": "rlon"},
    "p9b_navigation": {"lat": "nav_lat", "lon": "nav_lon"},
    "p9c_index_with_geographic": {"lat": "latitude", "lon": "longitude", "y": "j", "x": "i"},
    "p9d_index_with_short": {"lat": "lat", "lon": "lon", "y": "j", "x": "i"},
    "p9e_rotated_only": {"y": "rlat", "x": "rlon"},
    "p9f_cell_index": {"y": "nj", "x": "ni"},
    "p9g_already_short": {"lat": "lat", "lon": "lon"},
    "p9h_long_names": {"lat": "latitude", "lon": "longitude"},
    "p9i_plain_xy": {"lat": "y", "lon": "x"},
}


def _scheme_sql(names: dict[str, str]) -> str:
    keys = [c for c in ("lat", "lon", "y", "x") if c in names]
    return q.with_(q.GRID) + (
        f"SELECT {', '.join(keys)}, count(*) AS n, round(sum(tas), 6) AS tas FROM "
        "(SELECT lat, lon, lat * 4 AS y, lon * 4 AS x, tas FROM grid) GROUP BY " + ", ".join(keys)
    )


def _scheme(spark, sf, names):
    grid = tables.grid_daily(spark, sf)
    source = {"lat": F.col("lat"), "lon": F.col("lon"), "y": F.col("lat") * 4, "x": F.col("lon") * 4}
    raw = grid.select("time", *[source[c].alias(n) for c, n in names.items()], "tas")
    out = canon.rename_spatial(raw)
    keys = [c for c in ("lat", "lon", "y", "x") if c in names]
    return out.groupBy(*keys).agg(F.count("*").alias("n"), r6(F.sum("tas")).alias("tas"))


for _name, _names in _SCHEMES.items():
    query(_name, _scheme_sql(_names))(lambda spark, sf, n=_names: _scheme(spark, sf, n))


@query(
    "p9_canonicalise",
    q.with_(q.GRID)
    + """SELECT lon, lat, count(*) AS n, round(sum(tas), 6) AS tas
    FROM grid GROUP BY 1, 2""",
)
def p9(spark, sf):
    raw = tables.grid_daily(spark, sf).select(
        F.col("time").alias("valid_time"),
        F.col("lat").alias("latitude"),
        (F.col("lon") + 360).alias("longitude"),
        F.explode(F.sequence(F.lit(0), F.lit(2))).alias("number"),
        (F.col("tas") + F.col("number")).alias("t2m"),
    )
    out = canon.canonicalise(raw, "tas")
    return out.groupBy("lat", "lon").agg(F.count("*").alias("n"), r6(F.sum("tas")).alias("tas"))


@query(
    "p10_position_coordinate",
    q.with_(q.GRID)
    + """, k AS (SELECT time, lat, pr, row_number() OVER (PARTITION BY time, lat ORDER BY lon) - 1 AS lon FROM grid)
    SELECT lat, lon, count(*) AS n, round(sum(pr), 6) AS pr FROM k GROUP BY 1, 2""",
)
def p10(spark, sf):
    grid = tables.grid_daily(spark, sf)
    pairs = F.sort_array(F.collect_list(F.struct("lon", "pr")))
    nested = grid.groupBy("time", "lat").agg(pairs["pr"].alias("pr"))  # one row of the grid
    out = canon.ensure_coordinate(nested, "lon", "pr")
    return out.groupBy("lat", F.col("lon").cast("bigint").alias("lon")).agg(
        F.count("*").alias("n"), r6(F.sum("pr")).alias("pr")
    )


@query(
    "p11_ascending_latitudes",
    q.with_(q.GRID)
    + "SELECT lat, row_number() OVER (ORDER BY lat) - 1 AS position FROM (SELECT DISTINCT lat FROM grid)",
)
def p11(spark, sf):
    labels = canon.sort_latitudes(tables.grid_daily(spark, sf)).select(
        F.sort_array(F.collect_set("lat")).alias("axis")
    )
    return labels.select(F.posexplode("axis").alias("position", "lat")).withColumn(
        "position", F.col("position").cast("bigint")
    )


@query(
    "p12_wrap_longitudes",
    q.with_(q.GRID)
    + """, g AS (SELECT CASE WHEN lat > 30.5 THEN lon + 360 ELSE lon + 60 END AS lon, pr FROM grid),
    f AS (SELECT max(lon) > 180 AND min(lon) >= 0 AS wraps FROM g)
    SELECT CASE WHEN wraps AND lon > 180 THEN lon - 360 ELSE lon END AS lon, count(*) AS n, round(sum(pr), 6) AS pr
    FROM g, f GROUP BY 1""",
)
def p12(spark, sf):
    lon = F.when(F.col("lat") > 30.5, F.col("lon") + 360).otherwise(F.col("lon") + 60)
    out = canon.wrap_longitudes(tables.grid_daily(spark, sf).withColumn("lon", lon))
    return out.groupBy("lon").agg(F.count("*").alias("n"), r6(F.sum("pr")).alias("pr"))


@query(
    "p12_wrap_longitudes_guard",
    q.with_(q.GRID)
    + """SELECT CASE WHEN lat > 30.5 THEN lon + 360 ELSE lon END AS lon, count(*) AS n, round(sum(pr), 6) AS pr
    FROM grid GROUP BY 1""",
)
def p12_guard(spark, sf):
    # Some longitudes are negative, so nothing is wrapped.
    lon = F.when(F.col("lat") > 30.5, F.col("lon") + 360).otherwise(F.col("lon"))
    out = canon.wrap_longitudes(tables.grid_daily(spark, sf).withColumn("lon", lon))
    return out.groupBy("lon").agg(F.count("*").alias("n"), r6(F.sum("pr")).alias("pr"))


@query(
    "p13_first_member",
    """SELECT l_suppkey AS s, count(*) AS n, round(sum(l_tax), 6) AS tax FROM lineitem WHERE l_linenumber - 1 = 0 GROUP BY 1""",
)
def p13(spark, sf):
    items = tables.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("s"), "l_tax", (F.col("l_linenumber") - 1).alias("number")
    )
    out = canon.first_member(items)
    return out.groupBy("s").agg(F.count("*").alias("n"), r6(F.sum("l_tax")).alias("tax"))


@query(
    "p14_canonical_order",
    q.with_(q.GRID) + "SELECT CAST(time AS VARCHAR) AS time, lat, lon, tasmin, pr FROM grid",
)
def p14(spark, sf):
    out = canon.canonical_order(tables.grid_daily(spark, sf).select("pr", "lon", "tasmin", "time", "lat"))
    return out.withColumn("time", text("time")).select("time", "lat", "lon", "tasmin", "pr")


@query(
    "p15_crop_area",
    q.with_(q.GRID)
    + """SELECT lat, lon, count(*) AS n, round(sum(pr), 6) AS pr FROM grid
    WHERE lat BETWEEN 30.25 AND 30.75 AND lon BETWEEN -29.75 AND -29.25 GROUP BY 1, 2""",
)
def p15(spark, sf):
    out = canon.crop(tables.grid_daily(spark, sf), (30.75, -29.75, 30.25, -29.25))
    return out.groupBy(*CELL).agg(F.count("*").alias("n"), r6(F.sum("pr")).alias("pr"))


@query(
    "p16_date_range",
    q.with_(q.GRID)
    + """SELECT CAST(time AS VARCHAR) AS time, count(*) AS n FROM grid
    WHERE time BETWEEN DATE '1997-11-30' AND DATE '1999-02-01' GROUP BY 1""",
)
def p16(spark, sf):
    out = canon.between_dates(tables.grid_daily(spark, sf), "1997-11-30", "1999-02-01")
    return out.groupBy("time").agg(F.count("*").alias("n")).withColumn("time", text("time"))


_SPANS = {"both": (1996, 1998), "from": (1999, None), "until": (None, 1996), "all": (None, None)}


@query(
    "p17_year_spans",
    q.with_(q.GRID)
    + q.union(
        *[
            f"SELECT '{n}' AS span, lat, count(*) AS n, round(sum(pr), 6) AS pr FROM grid "
            f"WHERE year(time) BETWEEN {a or 0} AND {b or 9999} GROUP BY 2"
            for n, (a, b) in _SPANS.items()
        ]
    ),
)
def p17(spark, sf):
    grid = tables.grid_daily(spark, sf)
    hit = [
        F.when(YearSpan(a, b, strict=n == "both").contains(F.col("time")), F.lit(n))
        for n, (a, b) in _SPANS.items()
    ]
    rows = grid.select("lat", "pr", F.explode(F.array_compact(F.array(*hit))).alias("span"))
    return rows.groupBy("span", "lat").agg(F.count("*").alias("n"), r6(F.sum("pr")).alias("pr"))


def _season_sql(cond: str) -> str:
    return q.with_(q.GRID) + (
        f"SELECT lat, lon, year(time) AS year, count(*) AS n, max(tasmax) AS top FROM grid WHERE {cond} GROUP BY 1, 2, 3"
    )


def _season(spark, sf, window):
    rows = tables.grid_daily(spark, sf).where(window.contains(F.col("time")))
    return rows.groupBy(*CELL, F.year("time").cast("bigint").alias("year")).agg(
        F.count("*").alias("n"), F.max("tasmax").alias("top")
    )


_MD = "(month(time) * 100 + day(time))"


@query("p18_season_window", _season_sql(f"{_MD} BETWEEN 315 AND 920"))
def p18(spark, sf):
    return _season(spark, sf, SeasonWindow((3, 15), (9, 20)))


@query("p18_season_window_over_year_end", _season_sql(f"({_MD} BETWEEN 1115 AND 1130 OR {_MD} BETWEEN 301 AND 310)"))
def p18_unwrapped(spark, sf):
    return _season(spark, sf, SeasonWindow((11, 15), (3, 10)))


@query("p18_season_window_wrapped", _season_sql(f"({_MD} >= 1115 OR {_MD} <= 310)"))
def p18_wrapped(spark, sf):
    return _season(spark, sf, SeasonWindow((11, 15), (3, 10), wrap=True))


@query("p18_season_window_one_month", _season_sql("month(time) = 5 AND (day(time) >= 10 OR day(time) <= 20)"))
def p18_month(spark, sf):
    return _season(spark, sf, SeasonWindow((5, 10), (5, 20)))


@query(
    "p19_constant_thresholds",
    q.with_(q.GRID)
    + """, v AS (SELECT lat, lon, CASE WHEN pr > 15 THEN NULL ELSE pr END AS v FROM grid)
    SELECT lat, lon, CAST(count(*) FILTER (WHERE v > 6) AS BIGINT) AS gt, CAST(count(*) FILTER (WHERE v >= 6) AS BIGINT) AS ge,
      CAST(count(*) FILTER (WHERE v < 6) AS BIGINT) AS lt, CAST(count(*) FILTER (WHERE v <= 6) AS BIGINT) AS le
    FROM v GROUP BY 1, 2""",
)
def p19(spark, sf):
    v = F.when(F.col("pr") <= 15, F.col("pr"))
    return tables.grid_daily(spark, sf).groupBy(*CELL).agg(
        *[F.count_if(Threshold(6, op).holds(v)).alias(op) for op in ("gt", "ge", "lt", "le")]
    )


_DEAD = "lat = 30.5 AND lon = -29.75"


@query(
    "p20_all_missing_mask",
    q.with_(q.GRID)
    + f"""SELECT lat, lon, CAST({q.month()} AS VARCHAR) AS time,
      CASE WHEN {_DEAD} THEN NULL ELSE CAST(count(*) FILTER (WHERE pr >= 20 AND pr < 100) AS DOUBLE) END AS value
    FROM grid GROUP BY 1, 2, 3""",
)
def p20(spark, sf):
    dead = (F.col("lat") == 30.5) & (F.col("lon") == -29.75)
    pr = F.when(~dead, F.when(F.col("pr") < 100, F.col("pr")))
    out = indices.compute_index(
        tables.grid_daily(spark, sf).withColumn("pr", pr), indices.get_index("r20mm").index, MONTHLY
    )
    return out.withColumn("time", text("time"))


@query(
    "p20_nan_is_missing",
    q.with_(q.GRID)
    + """SELECT lat, lon, count(*) AS n, count(*) FILTER (WHERE pr <> 0) AS present, round(max(pr), 6) AS top
    FROM grid GROUP BY 1, 2""",
)
def p20_nan(spark, sf):
    noisy = F.when(F.col("pr") == 0, F.lit(float("nan"))).otherwise(F.col("pr"))
    grid = tables.grid_daily(spark, sf).withColumn("pr", numeric.missing_to_null(noisy))
    return grid.groupBy(*CELL).agg(
        F.count("*").alias("n"), F.count("pr").alias("present"), r6(F.max("pr")).alias("top")
    )


@query(
    "p21_time_filter",
    q.with_(q.GRID)
    + """, k AS (SELECT *, year(time) + CASE WHEN month(time) >= 11 THEN 1 ELSE 0 END AS y FROM grid
        WHERE month(time) >= 11 OR month(time) <= 2)
    SELECT lat, lon, y AS season_year, count(*) AS n, CAST(min(time) AS VARCHAR) AS first, CAST(max(time) AS VARCHAR) AS last
    FROM k WHERE y BETWEEN 1996 AND 1999 GROUP BY 1, 2, 3""",
)
def p21(spark, sf):
    rows = temporal.select_time_filter(tables.grid_daily(spark, sf), "11-02", "1996-1999")
    return rows.groupBy(*CELL, F.col("season_year").cast("bigint").alias("season_year")).agg(
        F.count("*").alias("n"), text(F.min("time")).alias("first"), text(F.max("time")).alias("last")
    )


@query(
    "p22_validated_frequencies",
    q.with_(q.GRID)
    + q.union(
        *[
            f"SELECT '{f}' AS freq, lat, CAST(count(*) FILTER (WHERE tasmax > 35) AS BIGINT) AS days, "
            f"count(DISTINCT {q.start(f)}) AS periods FROM grid GROUP BY 2"
            for f in STANDARD_FREQS
        ]
    ),
)
def p22(spark, sf):
    freqs = indices.validate_freqs(indices.get_index("tx35").index, None)
    out = indices.count_indices(tables.grid_daily(spark, sf), ("tx35",), freqs)
    return out.groupBy("freq", "lat").agg(
        F.sum("value").cast("bigint").alias("days"), F.count_distinct("time").alias("periods")
    )


@query(
    "p23_required_sources",
    """WITH need AS (SELECT index, variable, variable || '_None_ERA5_gridded.zarr' AS name FROM (VALUES
        ('tx30','tasmax'), ('fd','tasmin'), ('r1mm','pr'), ('r95ptot','pr')) v(index, variable)),
      have AS (SELECT DISTINCT ['tasmax', 'tas', 'pr'][(p_partkey % 3 + 1)::INT] || '_None_ERA5_gridded.zarr' AS name FROM part)
    SELECT index, variable, name FROM need n WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.name = n.name)""",
)
def p23(spark, sf):
    variable = F.array(F.lit("tasmax"), F.lit("tas"), F.lit("pr"))[(F.col("p_partkey") % 3).cast("int")]
    listing = tables.table(spark, sf, "part").select(
        F.concat(variable, F.lit("_None_ERA5_gridded.zarr")).alias("name")
    )
    required = catalog.required_stores(spark, ["tx30", "fd", "r1mm", "r95ptot"])
    return catalog.missing_stores(required, listing).select("index", "variable", "name")

