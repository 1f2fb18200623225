"""Grids, regions and logs derived from the test tables.

Everything grows with the tables: six suppliers share a grid cell, so cells and
rows rise together and a cell-day holds the same number of line items at every
scale, up to the 58,101 cells of a 0.25 degree European grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _div(value: Column, n: int) -> Column:
    return F.call_function("div", value, F.lit(n))


def cell_lat(supplier: Column) -> Column:
    return 30.0 + 0.25 * (_div(supplier, 24) % 181)


def cell_lon(supplier: Column) -> Column:
    return -30.0 + 0.25 * (_div(supplier, 6) % 4 + 4 * (_div(supplier, 4344) % 80))


def grid_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``time, lat, lon, tas, tasmin, tasmax, pr`` from line items.

    One row per cell and day that has any line item; about a quarter of the
    cell-days are absent.
    """
    items = table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity")
    return items.groupBy(
        F.to_date("l_shipdate").alias("time"),
        cell_lat(F.col("l_suppkey")).alias("lat"),
        cell_lon(F.col("l_suppkey")).alias("lon"),
    ).agg(
        (F.avg(quantity) - 9).alias("tas"),
        (F.min(quantity) - 10).alias("tasmin"),
        (F.max(quantity) - 8).alias("tasmax"),
        F.round(F.sum("l_tax") * 150, 6).alias("pr"),
    )


def grid_wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``time, lat, lon, u10, v10``."""
    return table(spark, sf_dir, "lineitem").groupBy(
        F.to_date("l_shipdate").alias("time"),
        cell_lat(F.col("l_suppkey")).alias("lat"),
        cell_lon(F.col("l_suppkey")).alias("lon"),
    ).agg(
        (F.max("l_discount") * 100 - 5).alias("u10"),
        (F.max("l_tax") * 100 - 3).alias("v10"),
    )


def second_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``time, lat, lon, psl`` from orders, on part of the same cells."""
    place = F.col("o_custkey") % 48
    return table(spark, sf_dir, "orders").groupBy(
        F.to_date("o_orderdate").alias("time"),
        cell_lat(place).alias("lat"),
        cell_lon(place).alias("lon"),
    ).agg(F.max("o_totalprice").alias("psl"))


def sub_daily(spark: SparkSession, events: DataFrame) -> DataFrame:
    """``ts, lat, lon, variable, value``: events as sub-daily observations."""
    pairs = {"view": "tas", "click": "tasmax", "signup": "tasmin", "purchase": "pr", "error": "sfcWind"}
    variable = F.lit(None).cast("string")
    for kind, name in pairs.items():
        variable = F.when(F.col("event_type") == kind, name).otherwise(variable)
    return events.select(
        "ts",
        (F.lit(30.0) + F.lit(0.25) * (F.col("user_id") % 16)).alias("lat"),
        (F.lit(-30.0) + F.lit(0.25) * (_div(F.col("user_id"), 16) % 4)).alias("lon"),
        variable.alias("variable"),
        "value",
    )


# Outlines around a point, as offsets: box, wide box, sliver, triangle, frame, tall box.
_SHAPES = (
    [[(-0.15, -0.15), (0.15, -0.15), (0.15, 0.15), (-0.15, 0.15), (-0.15, -0.15)]],
    [[(-0.15, -0.15), (0.55, -0.15), (0.55, 0.15), (-0.15, 0.15), (-0.15, -0.15)]],
    [[(0.05, -0.1), (0.06, -0.1), (0.06, 0.1), (0.05, 0.1), (0.05, -0.1)]],
    [[(-0.3, -0.2), (0.9, -0.2), (-0.3, 0.9), (-0.3, -0.2)]],
    [
        [(-0.35, -0.35), (0.35, -0.35), (0.35, 0.35), (-0.35, 0.35), (-0.35, -0.35)],
        [(-0.1, -0.1), (0.1, -0.1), (0.1, 0.1), (-0.1, 0.1), (-0.1, -0.1)],
    ],
    [[(-0.1, -0.6), (0.1, -0.6), (0.1, 0.6), (-0.1, 0.6), (-0.1, -0.6)]],
)


def _shape_text() -> str:
    def ring(points) -> str:
        return "array(" + ", ".join(f"named_struct('x', {x}D, 'y', {y}D)" for x, y in points) + ")"

    return "array(" + ", ".join("array(" + ", ".join(map(ring, s)) + ")" for s in _SHAPES) + ")"


def _outline(shape: str, x: str, y: str) -> str:
    """Shape number ``shape`` moved to ``(x, y)``."""
    return (
        f"transform(element_at({_shape_text()}, cast({shape} as int) + 1), "
        f"r -> transform(r, p -> named_struct('x', {x} + p.x, 'y', {y} + p.y)))"
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four nested-in-scale region sets: bands, country boxes, row strips, local shapes.

    Columns as in ``model.REGIONS_SCHEMA``.
    """
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation").join(
        F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")
    )
    supplier = table(spark, sf_dir, "supplier")

    level0 = region.withColumn("low", F.expr("29.875D + 9 * r_regionkey")).selectExpr(
        "'NUTS-0' region_set",
        "concat('B', r_regionkey) region",
        "r_name name",
        "r_name country",
        f"if(r_regionkey = 0, array({_box('-30.125D', 'low', '50.125D', 'low + 9')}, "
        f"{_box('-29.9D', '30.4D', '-29.6D', '30.6D')}), "
        f"array({_box('-30.125D', 'low', '50.125D', 'low + 9')})) rings",
    )
    level1 = nation.selectExpr(
        "*",
        "-30.125D + 0.2D * (n_nationkey % 5) x",
        "29.875D + 0.25D * (n_nationkey div 5) y",
        "if(n_nationkey % 11 = 10, 0.02D, 0.3D) width",
    ).selectExpr(
        "'NUTS-1' region_set",
        "concat('N', n_nationkey) region",
        "n_name name",
        "r_name country",
        f"array({_box('x', 'y', 'x + width', 'y + 0.25D')}) rings",
    )
    rows = supplier.selectExpr("s_suppkey div 24 row_no").distinct()
    level2 = rows.select("*", *_placed(F.col("row_no") * 24)).selectExpr(
        "'NUTS-2' region_set",
        "concat('R', row_no) region",
        "concat('Row ', row_no % 3) name",
        "concat('C', row_no % 2) country",
        f"array({_box('lon - 0.125D', 'lat - 0.125D', 'lon + 0.875D', 'lat + 0.125D')}) rings",
    )
    home = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    level3 = home.select("*", *_placed(F.col("s_suppkey"))).selectExpr(
        "'NUTS-3' region_set",
        "concat('S', s_suppkey) region",
        "concat('Area ', s_suppkey div 2) name",
        "n_name country",
        f"{_outline('s_suppkey % 6', 'lon', 'lat')} rings",
    )
    return level0.unionByName(level1).unionByName(level2).unionByName(level3)


def _placed(supplier: Column) -> list[Column]:
    return [cell_lon(supplier).alias("lon"), cell_lat(supplier).alias("lat")]


def _box(x0: str, y0: str, x1: str, y1: str) -> str:
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return "array(" + ", ".join(f"named_struct('x', {x}, 'y', {y})" for x, y in corners) + ")"


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_no, line``: forty events make the log of one run; every fifth run
    repeats an earlier id, and some lines are blank."""
    e = table(spark, sf_dir, "events")
    n = F.col("event_id")
    place, block = n % 40, _div(n, 40)
    run = F.when(block % 5 == 4, block - 4).otherwise(block)
    action = (
        F.when(place == 0, "/start")
        .when(place == 39, "/stop")
        .when(place % 10 == 2, "/create")
        .when(place % 10 == 7, "/create_end")
        .when(place % 10 == 8, "/output")
        .when(place % 10 == 1, "/input")
        .otherwise("/step")
    )
    pieces = [
        ('{"timestamp": "', F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")),
        ('", "request_id": "run-', run),
        ('", "task": "', F.col("event_type")),
        ('", "action": "', action),
        ('", "action_id": "act-', n),
        ('", "input_args": ["--user=', F.col("user_id")),
        ('", "--k=', place),
        ('"], "output_files": ["out_', n),
        ('.nc"], "props": ', F.col("props")),
    ]
    text = F.concat(*[c for lead, v in pieces for c in (F.lit(lead), v.cast("string"))], F.lit("}"))
    blank = (n % 7 == 0) & (place % 10).isin(4, 5)
    return e.select(n.alias("line_no"), F.when(blank, F.lit("  ")).otherwise(text).alias("line"))
