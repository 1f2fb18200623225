"""Shapes of physical plans that matter at scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from gridclim.operators import indices, percentiles, regions
from gridclim.plans import incremental, ingest
from gridclim.sources import manifest, metadata, store, tables

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "grid")
    store.write_store(store.with_year(tables.grid_daily(spark, SF_DIR)), path, partition_by=["year"])
    return path


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_projection_and_box_reach_the_scan(spark, stored):
    text = plan(store.read_store(spark, stored, "pr", box={"lat": (30.0, 30.5), "year": (1996, 1997)}))
    assert "PushedFilters: [IsNotNull(lat), GreaterThanOrEqual(lat,30.0)" in text
    assert "PartitionFilters: [isnotnull(year" in text
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "tasmax" not in schema and "pr" in schema


def test_percentile_index_exchanges_each_side_once(spark, stored, no_broadcast):
    grid = spark.read.parquet(stored)
    text = plan(indices.compute_index(grid, indices.get_index("r95ptot").index, "MS"))
    body = re.sub(r"Exchange SinglePartition", "", text)  # scalar bounds of the axis
    assert len(re.findall(r"Exchange hashpartitioning", body)) == 2
    assert "BroadcastExchange" not in body


def test_windows_are_merged_inside_the_cell(spark, stored):
    text = plan(percentiles.day_of_year_table(spark.read.parquet(stored), "pr", 95))
    assert len(re.findall(r"Exchange hashpartitioning\(cell", text)) == 1
    assert not re.findall(r"Exchange hashpartitioning\((?!cell)", text)


def test_rows_are_not_multiplied(spark):
    """Sixteen years of one cell: values away from a year's turn stay one row each."""
    day = F.date_add(F.lit("1992-01-01").cast("date"), F.col("id").cast("int"))
    grid = spark.range(5844).select(day.alias("time"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), F.col("id").cast("double").alias("pr"))
    held = percentiles.day_values(grid, "pr", percentiles.served_by_all(grid))
    sizes = held.agg(F.sum(F.size("own")), F.sum(F.size("single"))).first()
    assert sizes[0] == 16 * 360 - 2 + 2 and sizes[1] < 16 * 6 * 6
    windows = percentiles.day_windows(grid, "pr").select(F.posexplode_outer("windows").alias("p", "vs")).collect()
    first = dt.date(1992, 1, 1)
    for p in (0, 1, 2, 58, 59, 60, 180, 362, 363, 364, 365):
        want = []
        for n in range(5844):
            d = first + dt.timedelta(days=n)
            if d.timetuple().tm_yday == p + 1:
                want += [float(m) for m in range(n - 3, n + 3) if 0 <= m < 5844]
        assert windows[p].vs == sorted(want), p


def test_count_indices_read_daily_rows_once(spark, stored):
    text = plan(indices.count_indices_wide(spark.read.parquet(stored)))
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_polygon_join_is_an_equality_join(spark):
    cells = regions.cells_of(tables.grid_daily(spark, SF_DIR))
    text = plan(regions.cells_inside(cells, tables.regions(spark, SF_DIR)))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_scattered_regions_exchange_only_cell_rows(spark, stored, tmp_path):
    grid = spark.read.parquet(stored)
    table = regions.crosswalk(regions.cells_of(grid), tables.regions(spark, SF_DIR))
    path = str(tmp_path / "xwalk")
    table.write.parquet(path)
    text = plan(regions.aggregate_regions(grid, spark.read.parquet(path), ["pr"], scattered=True))
    assert re.findall(r"Exchange hashpartitioning\((\w+)", text) == ["time"]


@pytest.fixture
def fewer_keys(spark):
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    yield
    spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_tiles_exchange_only_sums_after_the_join(spark, stored, no_broadcast, fewer_keys, tmp_path):
    """A crosswalk beyond the broadcast limit: both sides by tile, then one row of sums per tile."""
    grid = spark.read.parquet(stored)
    path = str(tmp_path / "xwalk")
    regions.crosswalk(regions.cells_of(grid), tables.regions(spark, SF_DIR)).write.parquet(path)
    table = spark.read.parquet(path)
    text = plan(regions.aggregate_regions(grid, table, ["pr", "tas"], tile=2.0))
    assert sorted(re.findall(r"Exchange hashpartitioning\((\w+)", text)) == ["region_set", "tx", "tx"]
    join, last = text.index("SortMergeJoin"), text.index("Exchange hashpartitioning(region_set")
    assert last < join and "Exchange" not in text[last + 8 : join]
    assert re.search(r"HashAggregate\(keys=\[tx.*functions=\[sum", text[last:join])


def test_tiles_give_the_same_means(spark, stored, tmp_path):
    grid = spark.read.parquet(stored).withColumn("pr", F.when(F.col("lat") < 31, F.col("pr")))
    path = str(tmp_path / "xwalk")
    regions.crosswalk(regions.cells_of(grid), tables.regions(spark, SF_DIR)).write.parquet(path)
    table = spark.read.parquet(path)
    key = ["region_set", "region", "time"]
    want = regions.aggregate_regions(grid, table, ["pr", "tas"])
    for tile in (0.3, 5.0, 400.0):
        got = regions.aggregate_regions(grid, table, ["pr", "tas"], tile=tile)
        pair = want.withColumnsRenamed({"pr": "p", "tas": "t"}).join(got, key, "full")
        off = [(F.abs(F.col(a) - F.col(b)) > 1e-9) | (F.col(a).isNull() != F.col(b).isNull()) for a, b in (("p", "pr"), ("t", "tas"))]
        assert pair.where(off[0] | off[1]).count() == 0 and pair.count() == want.count()


def test_updates_read_only_touched_years(spark, stored, tmp_path):
    path = str(tmp_path / "copy")
    grid = spark.read.parquet(stored).drop("year")
    old = grid.where(F.col("time") < "2000-01-01")
    store.write_store(store.with_year(old), path, partition_by=["year"])
    files = {f for f in spark.read.parquet(path).inputFiles() if "year=1996" in f}
    assert incremental.update_grid(spark, path, grid, dt.date(2000, 3, 1))
    assert {f for f in spark.read.parquet(path).inputFiles() if "year=1996" in f} == files
    assert not incremental.update_grid(spark, path, grid, dt.date(2000, 3, 1))


def test_ingest_from_raw_names(spark):
    raw = tables.grid_daily(spark, SF_DIR).select(
        F.col("time").alias("valid_time"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        (F.col("tas") + 273.15).alias("t2m"),
    )
    out = ingest.homogenise(raw, "tas", "K", area=(31, -31, 29, -29))
    assert out.columns == ["time", "lat", "lon", "tas"]
    want = tables.grid_daily(spark, SF_DIR).agg(F.round(F.sum("tas"), 4)).first()[0]
    assert out.agg(F.round(F.sum("tas"), 4)).first()[0] == want


def test_merged_maps_are_worked_out_once(spark):
    """Maps merged into maps: an expression per map, not one per key and level."""
    attrs = F.create_map(F.lit("k"), F.concat(F.lit("marker"), F.col("id").cast("string")))
    for n in range(6):
        attrs = metadata.merged(F.create_map(F.lit(f"k{n}"), F.lit("v")), attrs)
    row = spark.range(3).select(attrs.alias("attrs"))
    assert plan(row).split("== Initial Plan ==")[0].count("marker") == 1
    assert row.collect()[2]["attrs"] == {**{f"k{n}": "v" for n in range(6)}, "k": "marker2"}


def test_attributes_are_dealt_before_they_are_merged(spark, tmp_path):
    """Few files are no reason for few tasks: merging costs more than moving."""
    path = str(tmp_path / "attributes")
    spark.range(9).select(F.col("id").cast("string").alias("dataset"), F.create_map(F.lit("k"), F.lit("v")).alias("attrs")).coalesce(1).write.parquet(path)
    stored = spark.read.parquet(path)
    assert "Exchange hashpartitioning(dataset" in plan(incremental.merge_attributes(stored, stored))


def test_ranges_are_dealt_before_they_become_requests(spark, tmp_path):
    """Equal ranges of one file, thousands of days each, are not the work of one task."""
    path = str(tmp_path / "ranges")
    day = [F.to_date(F.lit(d)).alias(n) for d, n in (("2000-01-01", "start"), ("2009-12-31", "end"))]
    spark.range(64).select(F.lit("pr").alias("variable"), F.lit("500").alias("level"), *day, F.lit("daily").alias("grain")).coalesce(1).write.parquet(path)
    made = manifest.requests(spark.read.parquet(path), "/data")
    sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 64 * 3653 and max(sizes) <= sum(sizes) / 4


def _same(want, got, variables):
    key = ["region_set", "region", "time"]
    pair = want.withColumnsRenamed({v: f"want_{v}" for v in variables}).join(got, key, "full")
    off = [(F.abs(F.col(f"want_{v}") - F.col(v)) > 1e-9) | (F.col(f"want_{v}").isNull() != F.col(v).isNull()) for v in variables]
    bad = off[0]
    for o in off[1:]:
        bad = bad | o
    return pair.where(bad).count() == 0 and pair.count() == want.count() == got.count()


@pytest.fixture(scope="module")
def crossed(spark, stored, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("crossed") / "xwalk")
    regions.crosswalk(regions.cells_of(spark.read.parquet(stored)), tables.regions(spark, SF_DIR)).write.parquet(path)
    return spark.read.parquet(path)


def test_packed_days_give_the_same_means(spark, stored, crossed):
    """Missing values, days before 1970, cells with two rows a day, and more variables than slots of one."""
    grid = spark.read.parquet(stored).drop("year").withColumn("pr", F.when(F.col("lat") < 31, F.col("pr")))
    old = grid.where(F.month("time") == 3).withColumn("time", F.add_months("time", -12 * 40))
    grid = grid.unionByName(old).unionByName(grid.where(F.dayofmonth("time") == 9).withColumn("tas", F.col("tas") + 5))
    for names in (["pr"], ["pr", "tas"], ["pr", "tas", "tasmin", "tasmax"]):
        want = regions.aggregate_regions(grid, crossed, names)
        assert _same(want, regions.aggregate_days(grid, crossed, names), names)
    due = spark.createDataFrame([("NUTS-0", dt.date(1999, 5, d)) for d in (1, 2, 30)] + [("NUTS-3", dt.date(1999, 5, 2))], "region_set string, time date")
    want = regions.aggregate_regions(grid, crossed, ["pr"]).join(due, ["region_set", "time"]).select("region_set", "region", "time", "pr")
    assert _same(want, regions.aggregate_days(grid, crossed, ["pr"], due), ["pr"])


@pytest.mark.parametrize("how", ["days", "tiles"])
def test_a_region_meets_a_cell_once_per_block_of_days(spark, stored, crossed, how):
    """Rows of a cell and block are one row below the join with the crosswalk."""
    grid = spark.read.parquet(stored)
    means = regions.aggregate_days(grid, crossed, ["pr"]) if how == "days" else regions.aggregate_regions(grid, crossed, ["pr"], tile=2.0)
    text = plan(means).split("== Initial Plan ==")[0]
    below = text[text.index("HashJoin") :]
    assert "HashAggregate(keys=[tx" in below and "_block" in below.split("HashAggregate(keys=[tx")[1].split("]")[0]
