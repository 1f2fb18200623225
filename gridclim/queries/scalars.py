"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import registries
from ..functions import calendar, numeric
from ..functions import text as strings
from ..model import ANNUAL, MONTHLY, SEASONAL, STANDARD_FREQS
from ..operators import combine, resample, runlog
from ..sources import manifest, tables
from . import query
from . import sql as q
from .common import big, flag, r6, text

_DAYS = "days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"


def _days(spark, sf):
    return tables.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()


_SEASON_NAME = (
    "CASE WHEN month(d) IN (12, 1, 2) THEN 'DecFeb' WHEN month(d) <= 5 THEN 'MarMay' "
    "WHEN month(d) <= 8 THEN 'JunAug' ELSE 'SepNov' END"
)


@query(
    "x1_month_range_names",
    q.with_(_DAYS)
    + f"""SELECT CAST(d AS VARCHAR) AS day, strftime(d, '%b') AS month_name, {_SEASON_NAME} AS season_name,
      CASE WHEN month(d) >= 10 OR month(d) <= 3 THEN 'cool' ELSE 'warm' END AS half FROM days""",
)
def x1(spark, sf):
    month = F.month("d")
    return _days(spark, sf).select(
        text("d").alias("day"),
        calendar.range_name(month, calendar.MONTH_RANGES).alias("month_name"),
        calendar.range_name(month, calendar.SEASON_RANGES).alias("season_name"),
        calendar.range_name(month, [("cool", 10, 3), ("warm", 4, 9)]).alias("half"),
    )


@query(
    "x2_time_reference",
    q.with_(_DAYS)
    + f", s AS (SELECT d, {q.season('d')} AS s FROM days) "
    + f"""SELECT CAST(d AS VARCHAR) AS day, CAST(s AS VARCHAR) AS season_start,
      CAST({q.reference("'QS-DEC'", 's')} AS VARCHAR) AS seasonal, CAST({q.month('d')} AS VARCHAR) AS monthly,
      CAST({q.year('d')} AS VARCHAR) AS annual FROM s""",
)
def x2(spark, sf):
    d = F.col("d")

    def reference(freq):
        return text(calendar.time_reference(calendar.period_start(d, freq), freq))

    return _days(spark, sf).select(
        text("d").alias("day"),
        text(calendar.period_start(d, SEASONAL)).alias("season_start"),
        reference(SEASONAL).alias("seasonal"),
        reference(MONTHLY).alias("monthly"),
        reference(ANNUAL).alias("annual"),
    )


@query(
    "x3_reverse_time_reference",
    q.with_(_DAYS)
    + f"SELECT CAST(d AS VARCHAR) AS day, CAST({q.season('d')} AS VARCHAR) AS seasonal, "
    f"CAST({q.month('d')} AS VARCHAR) AS monthly FROM days",
)
def x3(spark, sf):
    def back(freq):
        start = calendar.period_start(F.col("d"), freq)
        return text(calendar.reverse_time_reference(calendar.time_reference(start, freq), freq))

    return _days(spark, sf).select(
        text("d").alias("day"), back(SEASONAL).alias("seasonal"), back(MONTHLY).alias("monthly")
    )


@query(
    "x4_calendar_component",
    q.with_(_DAYS)
    + f"""SELECT 'year' AS component, 'Annual' AS key, count(*) AS n FROM days
      UNION ALL SELECT 'season', {_SEASON_NAME}, count(*) FROM days GROUP BY 2
      UNION ALL SELECT 'month', strftime(d, '%b'), count(*) FROM days GROUP BY 2""",
)
def x4(spark, sf):
    entries = [
        F.struct(
            F.lit(calendar.component(f)).alias("component"), calendar.period_key(F.col("d"), f).alias("key")
        )
        for f in STANDARD_FREQS
    ]
    rows = _days(spark, sf).select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return rows.groupBy("component", "key").agg(F.count("*").alias("n"))


@query(
    "x5_record_labels",
    q.with_(q.GRID)
    + ", r AS ("
    + q.union(
        *[f"SELECT '{f}' AS freq, lat, {q.start(f)} AS time, count(*) AS n FROM grid GROUP BY 2, 3" for f in q.STARTS]
    )
    + f") SELECT freq, lat, CAST({q.reference()} AS VARCHAR) AS time, {q.filter_name()} AS time_filter, n FROM r",
)
def x5(spark, sf):
    grid = tables.grid_daily(spark, sf)
    out = None
    for f in STANDARD_FREQS:
        part = combine.label_periods(resample.resample(grid, f, {"n": F.count("*")}, ("lat",)), f)
        part = part.select(F.lit(f).alias("freq"), "lat", text("time").alias("time"), "time_filter", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "x6_time_filter_table",
    q.with_(q.GRID)
    + """, f AS (SELECT * FROM (VALUES ('Annual','01-12'), ('DecFeb','12-02'), ('MarMay','03-05'), ('JunAug','06-08'),
      ('SepNov','09-11'), ('Jan','01-01'), ('Feb','02-02'), ('Mar','03-03'), ('Apr','04-04'), ('May','05-05'), ('Jun','06-06'),
      ('Jul','07-07'), ('Aug','08-08'), ('Sep','09-09'), ('Oct','10-10'), ('Nov','11-11'), ('Dec','12-12')) v(time_filter, months)),
    b AS (SELECT *, CAST(months[1:2] AS INT) AS a, CAST(months[4:5] AS INT) AS z FROM f)
    SELECT time_filter, months, count(*) AS n, round(sum(pr), 5) AS pr FROM grid, b
    WHERE CASE WHEN a <= z THEN month(time) BETWEEN a AND z ELSE month(time) >= a OR month(time) <= z END GROUP BY 1, 2""",
)
def x6(spark, sf):
    monthly = tables.grid_daily(spark, sf).groupBy(F.month("time").alias("month")).agg(
        F.count("*").alias("n"), F.sum("pr").alias("pr")
    )
    return (
        monthly.join(F.broadcast(registries.filter_months(spark)), "month")
        .groupBy("time_filter", "months")
        .agg(F.sum("n").alias("n"), F.round(F.sum("pr"), 5).alias("pr"))
    )


@query(
    "x6_named_periods",
    """WITH p AS (SELECT * FROM (VALUES ('baseline', 1995, 2014), ('near_future', 2021, 2040), ('medium_future', 2041, 2060),
        ('far_future', 2081, 2100)) v(period, a, z)),
      v AS (SELECT * FROM (VALUES ('water_level', 2), ('waves_dir', 1), ('waves_dp', 4), ('waves_dpt', 1), ('waves_fp', 1), ('waves_hs', 4),
        ('waves_t02', 1), ('waves_t0m1', 1), ('waves_tp', 4), ('waves_VPED', 1), ('waves_VTPK', 1), ('wind_100m', 4), ('wind_10m', 4),
        ('wind_150m', 4), ('wind_200m', 4), ('wind_dd', 1)) v(variable, k)),
      o AS (SELECT o_custkey % 110 + 1991 AS y, count(*) AS n FROM orders GROUP BY 1)
    SELECT variable, period, CAST(sum(n) AS BIGINT) AS n FROM v JOIN p ON CASE period WHEN 'baseline' THEN 1 WHEN 'near_future' THEN 2
      WHEN 'medium_future' THEN 3 ELSE 4 END <= k JOIN o ON y BETWEEN a AND z GROUP BY 1, 2""",
)
def x6_periods(spark, sf):
    orders = tables.table(spark, sf, "orders")
    yearly = orders.groupBy((F.col("o_custkey") % 110 + 1991).cast("int").alias("year")).agg(
        F.count("*").alias("n")
    )
    return (
        yearly.join(F.broadcast(registries.period_years(spark)), "year")
        .groupBy("variable", "period")
        .agg(F.sum("n").alias("n"))
    )


@query(
    "x7_weights_and_affine",
    q.with_(q.GRID)
    + """SELECT lat, round(cos(radians(lat)), 6) AS w, round(sum(sqrt(pow(tasmin, 2) + pow(tasmax, 2))), 5) AS speed,
      round(sum(tas * CAST(1.8 AS DOUBLE) + 32), 5) AS fahrenheit FROM grid GROUP BY 1""",
)
def x7(spark, sf):
    speed = numeric.wind_speed(F.col("tasmin"), F.col("tasmax"))
    fahrenheit = numeric.affine(F.col("tas"), F.lit(1.8), F.lit(32.0))
    out = tables.grid_daily(spark, sf).groupBy("lat").agg(
        F.round(F.sum(speed), 5).alias("speed"), F.round(F.sum(fahrenheit), 5).alias("fahrenheit")
    )
    return out.withColumn("w", r6(numeric.latitude_weight(F.col("lat"))))


@query(
    "x8_padded_lists",
    q.with_(_DAYS)
    + """SELECT CAST(d AS VARCHAR) AS day, strftime(d, '%d') AS one,
      array_to_string([lpad(x::VARCHAR, 2, '0') for x in range(1, day(last_day(d)) + 1)], ',') AS month_days,
      strftime(d, '%m') AS month FROM days""",
)
def x8(spark, sf):
    d = F.col("d")

    def joined(values):
        return F.array_join(values, ",")

    return _days(spark, sf).select(
        text("d").alias("day"),
        joined(manifest.days_of(d, F.lit("daily"))).alias("one"),
        joined(manifest.days_of(d, F.lit("monthly"))).alias("month_days"),
        joined(manifest.months_of(d, F.lit("daily"))).alias("month"),
    )


_OBJECTS = """o AS (SELECT o_orderkey AS id, ['s3://', '', 's3:///', 'file:/'][(o_orderkey % 4 + 1)::INT] || 'b' || o_custkey ||
    ['/dir/tas_' || o_orderkey || '.nc', '', '/x.zarr'][(o_orderkey % 3 + 1)::INT] AS path FROM orders)"""


@query(
    "x9_path_text",
    q.with_(_OBJECTS)
    + """, n AS (SELECT *, CASE WHEN path LIKE 's3://%' THEN path[6:] ELSE path END AS rest FROM o)
    SELECT id, path, split_part(rest, '/', 1) AS bucket, CASE WHEN contains(rest, '/') THEN rest[instr(rest, '/') + 1:] ELSE '' END AS key,
      CAST(path LIKE 's3://%' AND path NOT LIKE 's3:///%' AND length(path) > 5 AS BIGINT) AS is_object,
      CAST(split_part(path, '/', -1) GLOB 'tas_*[02468].nc' AS BIGINT) AS matches FROM n""",
)
def x9(spark, sf):
    k = F.col("o_orderkey")
    scheme = F.array(F.lit("s3://"), F.lit(""), F.lit("s3:///"), F.lit("file:/"))[(k % 4).cast("int")]
    tail = F.array(F.concat(F.lit("/dir/tas_"), text(k), F.lit(".nc")), F.lit(""), F.lit("/x.zarr"))
    path = F.concat(scheme, F.lit("b"), text("o_custkey"), tail[(k % 3).cast("int")])
    rows = tables.table(spark, sf, "orders").select(k.alias("id"), path.alias("path"))
    pattern = strings.glob_to_regex("tas_*[02468].nc")
    return rows.select(
        "id",
        "path",
        strings.bucket(F.col("path")).alias("bucket"),
        strings.key(F.col("path")).alias("key"),
        flag(strings.is_object_path(F.col("path"))).alias("is_object"),
        flag(strings.basename(F.col("path")).rlike(pattern)).alias("matches"),
    )


_INPUTS = """i AS (SELECT o_orderkey AS id, o_orderkey % 7 AS kind, CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN '75;-30;30.5;' || o_custkey
      WHEN 2 THEN '1;2;3' WHEN 3 THEN '1;2;x;4' WHEN 4 THEN '  ' WHEN 5 THEN NULL ELSE '1;2;3;4;5' END AS area,
    CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y')
      WHEN 3 THEN '2023-02-30' WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00' ELSE ' ' END AS day, o_orderkey % 6 AS dkind,
    o_custkey FROM orders)"""


@query(
    "x10_input_validation",
    q.with_(_INPUTS)
    + """SELECT id, CASE WHEN kind IN (0, 4, 5) THEN 'absent' WHEN kind = 1 THEN 'ok' ELSE 'invalid' END AS area_state,
      CASE WHEN kind = 1 THEN 75 - 30 + CAST(30.5 AS DOUBLE) + o_custkey END AS area_sum,
      CASE WHEN kind IN (0, 4, 5) THEN 'absent' WHEN kind = 2 THEN 'ok' ELSE 'invalid' END AS chunk_state,
      CASE WHEN dkind IN (0, 5) THEN 'absent' WHEN dkind = 1 THEN 'ok' ELSE 'invalid' END AS day_state,
      CASE WHEN dkind = 1 THEN day END AS day FROM i""",
)
def x10(spark, sf):
    k = F.col("o_orderkey")
    area = (
        F.when(k % 7 == 0, "")
        .when(k % 7 == 1, F.concat(F.lit("75;-30;30.5;"), text("o_custkey")))
        .when(k % 7 == 2, "1;2;3")
        .when(k % 7 == 3, "1;2;x;4")
        .when(k % 7 == 4, "  ")
        .when(k % 7 == 5, F.lit(None))
        .otherwise("1;2;3;4;5")
    )
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    day = (
        F.when(k % 6 == 0, "")
        .when(k % 6 == 1, iso)
        .when(k % 6 == 2, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(k % 6 == 3, "2023-02-30")
        .when(k % 6 == 4, F.concat(iso, F.lit("T00")))
        .otherwise(" ")
    )
    rows = tables.table(spark, sf, "orders").select(k.alias("id"), area.alias("a"), day.alias("d"))
    a, d = F.col("a"), F.col("d")
    numbers, date = strings.parse_numbers(a, 4), strings.parse_date(d)
    total = F.aggregate(F.col("numbers"), F.lit(0.0), lambda acc, v: acc + v)
    return rows.withColumn("numbers", numbers).select(
        "id",
        strings.input_state(a, F.col("numbers")).alias("area_state"),
        total.alias("area_sum"),
        strings.input_state(a, strings.parse_numbers(a, 3)).alias("chunk_state"),
        strings.input_state(d, date).alias("day_state"),
        text(date).alias("day"),
    )


@query(
    "x11_json_fields",
    """SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 6) AS value
    FROM events GROUP BY 1, 2""",
)
def x11(spark, sf):
    parsed = F.from_json("props", "k bigint")["k"]
    events = tables.table(spark, sf, "events")
    return events.groupBy("event_type", parsed.alias("k")).agg(
        F.count("*").alias("n"), r6(F.sum("value")).alias("value")
    )


@query(
    "x11_json_lines",
    """WITH l AS (SELECT event_id AS line_no FROM events
      WHERE NOT (event_id % 7 = 0 AND (event_id % 40) % 10 IN (4, 5)))
    SELECT CAST(count(*) AS BIGINT) AS lines, CAST(count(DISTINCT line_no) AS BIGINT) AS distinct_lines FROM l""",
)
def x11_lines(spark, sf):
    rows = runlog.parse_lines(tables.log_lines(spark, sf))
    return rows.agg(big(F.count("action")).alias("lines"), big(F.count_distinct("line_no")).alias("distinct_lines"))

