"""Hand-computed results on small inputs."""

import datetime as dt
import math
import shutil

import pytest
from pyspark.sql import functions as F

from gridclim import queries
from gridclim.functions import calendar, geometry, numeric, text
from gridclim.model import (
    ANNUAL,
    MONTHLY,
    SEASONAL,
    IndexContext,
    IndexDef,
    PercentileSpec,
    SeasonWindow,
    Threshold,
    YearSpan,
)
from gridclim.operators import (
    canon,
    combine,
    completeness,
    indices,
    percentiles,
    quality,
    regions,
    resample,
    runlog,
    temporal,
    units,
)
from gridclim.plans import incremental
from gridclim.sources import catalog, manifest, naming, store

D = dt.date


def series(spark, values, name, start=D(2020, 1, 1), lat=0.0, lon=0.0):
    rows = [(start + dt.timedelta(days=i), lat, lon, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"time date, lat double, lon double, {name} double")


def one(df, column):
    rows = df.select(column).collect()
    assert len(rows) == 1
    return rows[0][0]


@pytest.fixture(scope="module")
def daily(spark):
    return spark.sql(
        "SELECT explode(sequence(DATE '2020-01-01', DATE '2021-12-31')) AS time, 0D AS lat, 0D AS lon"
    ).withColumn("temp", F.dayofyear("time").cast("double"))


def test_time_filter_selects_months(daily):
    assert temporal.select_time_filter(daily, "01-02").count() == 60 + 59


def test_climatology_and_series(daily):
    clim = temporal.seasonal_statistic(daily, "temp", "mean", "01-02", "climatology")
    assert clim.count() == 1
    years = temporal.seasonal_statistic(daily, "temp", "mean", "01-02", "temporal_series")
    assert sorted(r["time"] for r in years.collect()) == [D(2020, 1, 1), D(2021, 1, 1)]
    with pytest.raises(NotImplementedError):
        temporal.seasonal_statistic(daily, "temp", "mean", "01-02", "other")


def test_first_crossing_season_is_kept_although_partial(daily):
    rows = temporal.select_time_filter(daily, "12-02").groupBy("season_year").count().collect()
    assert {r["season_year"]: r["count"] for r in rows} == {2020: 60, 2021: 31 + 59}


@pytest.mark.parametrize("name, expected", [("tx30", 4), ("tx35", 2), ("tx40", 1)])
def test_hot_days_are_strictly_above(spark, name, expected):
    grid = series(spark, [30.0, 30.1, 35.0, 35.1, None, 41.0], "tasmax")
    assert one(indices.compute_index(grid, indices.get_index(name).index, MONTHLY), "value") == expected


@pytest.mark.parametrize("name, expected", [("fd", 1), ("tr20", 2), ("tr25", 1)])
def test_cold_and_warm_nights(spark, name, expected):
    grid = series(spark, [-0.1, 0.0, 0.1, 20.0, 20.1, 25.1], "tasmin")
    assert one(indices.compute_index(grid, indices.get_index(name).index, MONTHLY), "value") == expected


@pytest.mark.parametrize("name, expected", [("r1mm", 4), ("r20mm", 2)])
def test_wet_days_include_the_threshold(spark, name, expected):
    grid = series(spark, [0.0, 0.9, 1.0, 19.9, 20.0, 25.0], "pr")
    assert one(indices.compute_index(grid, indices.get_index(name).index, MONTHLY), "value") == expected


def test_cell_without_data_is_missing_not_zero(spark):
    empty = series(spark, [None] * 40, "pr")
    full = series(spark, [0.0] * 40, "pr", lat=1.0)
    grid = empty.unionByName(full)
    out = indices.compute_index(grid, indices.get_index("r1mm").index, MONTHLY).collect()
    assert {r["value"] for r in out if r["lat"] == 0.0} == {None}
    assert {r["value"] for r in out if r["lat"] == 1.0} == {0.0}
    wide = indices.count_indices_wide(grid, ("r1mm",)).collect()
    assert {r["r1mm"] for r in wide if r["lat"] == 0.0} == {None}


def test_mask_for_hooks_without_counts(spark):
    grid = series(spark, [None] * 5, "pr").unionByName(series(spark, [2.0] * 5, "pr", lat=1.0))

    def zero(df, context: IndexContext):
        return resample.resample(df, context.freq, {context.variable: F.lit(0.0)})

    hook = IndexDef("zero", "", "1", ("pr",), direct=zero, needs="single_dataset")
    out = {r["lat"]: r["value"] for r in indices.compute_index(grid, hook, MONTHLY).collect()}
    assert out == {0.0: None, 1.0: 0.0}


SEASON_DAYS = [D(2023, 12, 31), D(2024, 2, 29), D(2024, 3, 1), D(2024, 11, 30)]


def test_season_starts_and_references(spark):
    days = spark.createDataFrame([(d,) for d in SEASON_DAYS], "d date")
    start = calendar.period_start(F.col("d"), SEASONAL)
    rows = days.orderBy("d").select(
        start.alias("s"),
        calendar.time_reference(start, SEASONAL).alias("r"),
        calendar.filter_name(start, SEASONAL).alias("f"),
        calendar.reverse_time_reference(calendar.time_reference(start, SEASONAL), SEASONAL).alias("b"),
    ).collect()
    assert [r["s"] for r in rows] == [D(2023, 12, 1), D(2023, 12, 1), D(2024, 3, 1), D(2024, 9, 1)]
    assert [(r["f"], r["r"]) for r in rows] == [
        ("DecFeb", D(2024, 1, 1)),
        ("DecFeb", D(2024, 1, 1)),
        ("MarMay", D(2024, 3, 1)),
        ("SepNov", D(2024, 9, 1)),
    ]
    assert [r["b"] for r in rows] == [r["s"] for r in rows]


def test_month_outside_all_ranges_fails(spark):
    df = spark.range(1).select(calendar.range_name(F.lit(5), [("Jan", 1, 1)]).alias("n"))
    with pytest.raises(Exception, match="no range holds month"):
        df.collect()


def xwalk_of(spark, weights):
    rows = [("NUTS-0", "R", lat, lon, w, False) for (lat, lon), w in weights.items()]
    return spark.createDataFrame(
        rows, "region_set string, region string, lat double, lon double, w double, filled boolean"
    )


def test_weighted_mean_skips_missing_in_both_sums(spark):
    weights = {(0.0, 0.0): 1.0, (60.0, 0.0): math.cos(math.radians(60))}
    table = xwalk_of(spark, weights)

    def mean(north):
        grid = series(spark, [10.0], "v").unionByName(series(spark, [north], "v", lat=60.0))
        return one(regions.aggregate_regions(grid, table, ["v"]), "v")

    assert mean(40.0) == pytest.approx(20.0)
    assert mean(None) == 10.0
    assert one(regions.aggregate_regions(series(spark, [None], "v"), table, ["v"]), "v") is None


def test_constant_field_stays_constant(spark):
    grid = series(spark, [7.5] * 10, "v").unionByName(series(spark, [7.5] * 10, "v", lat=60.0))
    table = xwalk_of(spark, {(0.0, 0.0): 1.0, (60.0, 0.0): 0.5})
    for scattered in (False, True):
        out = regions.aggregate_regions(grid, table, ["v"], scattered=scattered).collect()
        assert len(out) == 10 and all(r["v"] == pytest.approx(7.5) for r in out)


def box(x0, y0, x1, y1):
    x0, y0, x1, y1 = map(float, (x0, y0, x1, y1))
    return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]


def region_table(spark, shapes):
    rows = [("NUTS-0", n, n, "C", rings) for n, rings in shapes.items()]
    return spark.createDataFrame(
        rows,
        "region_set string, region string, name string, country string, "
        "rings array<array<struct<x:double,y:double>>>",
    )


def grid_cells(spark, lats, lons):
    return spark.createDataFrame([(a, o) for a in lats for o in lons], "lat double, lon double")


def test_two_square_regions_on_a_small_grid(spark):
    axis = [0.0, 2.5, 5.0, 7.5, 10.0]
    shapes = region_table(spark, {"A": box(0, 0, 5, 5), "B": box(5, 5, 10, 10)})
    hits = regions.cells_inside(grid_cells(spark, axis, axis), shapes, tile=3.0).collect()
    found = {n: {(r["lat"], r["lon"]) for r in hits if r["region"] == n} for n in "AB"}
    # Edges are half open: the low sides belong to the box, the high ones do not.
    assert found["A"] == {(a, o) for a in (0.0, 2.5) for o in (0.0, 2.5)}
    assert found["B"] == {(a, o) for a in (5.0, 7.5) for o in (5.0, 7.5)}


@pytest.mark.parametrize("tile", [0.7, 1.0, 25.0])
def test_holes_overlaps_and_slivers(spark, tile):
    shapes = region_table(
        spark,
        {
            "ring": box(-0.5, -0.5, 4.5, 4.5) + box(0.5, 0.5, 3.5, 3.5),
            "all": box(-0.5, -0.5, 4.5, 4.5),
            "sliver": box(1.2, 1.2, 1.3, 1.3),
            "triangle": [[(-0.1, -0.1), (2.1, -0.1), (-0.1, 2.1)]],  # open ring
        },
    )
    axis = [float(i) for i in range(5)]
    cells = grid_cells(spark, axis, axis)
    hits = regions.cells_inside(cells, shapes, tile)
    counts = {r["region"]: r["count"] for r in hits.groupBy("region").count().collect()}
    assert counts == {"ring": 25 - 9, "all": 25, "triangle": 3 + 2 + 1 - 3}
    assert [r["region"] for r in regions.empty_regions(shapes, hits).collect()] == ["sliver"]


def test_nearest_cell_tie_takes_the_larger(spark):
    shapes = region_table(spark, {"s": box(0.4, 0.4, 0.6, 0.6)})
    row = regions.nearest_cells(shapes, grid_cells(spark, [0.0, 1.0], [0.0, 1.0])).first()
    assert (row["lat"], row["lon"]) == (1.0, 1.0)


def test_crosswalk_fills_and_weights(spark):
    shapes = region_table(spark, {"s": box(0.4, 0.4, 0.45, 0.45), "b": box(-0.5, 59.5, 0.5, 60.5)})
    table = regions.crosswalk(grid_cells(spark, [0.0, 60.0], [0.0, 1.0]), shapes)
    rows = {r["region"]: r for r in table.collect()}
    assert rows["s"]["filled"] and rows["s"]["w"] == 1.0 and rows["s"]["lat"] == 0.0
    assert not rows["b"]["filled"] and rows["b"]["w"] == pytest.approx(0.5)


def test_repeated_region_names(spark):
    rows = [("NUTS-0", "1", "X", "A", []), ("NUTS-0", "2", "X", "B", []), ("NUTS-1", "3", "X", "A", [])]
    df = spark.createDataFrame(
        rows,
        "region_set string, region string, name string, country string, "
        "rings array<array<struct<x:double,y:double>>>",
    )
    labels = {r["region"]: r["label"] for r in regions.unique_names(df).collect()}
    assert labels == {"1": "X (A)", "2": "X (B)", "3": "X"}


@pytest.mark.parametrize(
    "given, expected", [([0.0, 180.0, 181.0, 359.0], [-179.0, -1.0, 0.0, 180.0]), ([-10.0, 200.0], [-10.0, 200.0])]
)
def test_longitudes(spark, given, expected):
    df = spark.createDataFrame([(v,) for v in given], "lon double")
    assert sorted(r["lon"] for r in canon.wrap_longitudes(df).collect()) == expected


@pytest.mark.parametrize(
    "columns, expected",
    [
        (["rlon", "rlat", "longitude", "latitude"], ["x", "y", "lon", "lat"]),
        (["nav_lon", "nav_lat"], ["lon", "lat"]),
        (["i", "j", "longitude", "latitude"], ["x", "y", "lon", "lat"]),
        (["i", "j", "lon", "lat"], ["x", "y", "lon", "lat"]),
        (["rlon", "rlat"], ["x", "y"]),
        (["ni", "nj"], ["x", "y"]),
        (["lon", "lat"], ["lon", "lat"]),
        (["longitude", "latitude"], ["lon", "lat"]),
        (["x", "y"], ["lon", "lat"]),
    ],
)
def test_spatial_names(spark, columns, expected):
    df = spark.createDataFrame([], ", ".join(f"{c} double" for c in columns))
    assert canon.rename_spatial(df).columns == expected


def test_unknown_spatial_names(spark):
    with pytest.raises(NotImplementedError):
        canon.rename_spatial(spark.createDataFrame([], "a double, b double"))


def test_rename_needs_one_variable(spark):
    with pytest.raises(ValueError):
        canon.rename_variable(spark.createDataFrame([], "time date, lat double, lon double, a int, b int"), "v")


@pytest.mark.parametrize(
    "variable, unit, value, expected",
    [("tas", "K", 300.0, 26.85), ("pr", "m", 0.002, 2.0), ("sfcWind", "km h**-1", 36.0, 10.0)],
)
def test_unit_conversion(spark, variable, unit, value, expected):
    df = spark.createDataFrame([(variable, unit, value)], "variable string, unit string, value double")
    assert one(units.convert_units(df), "value") == pytest.approx(expected)
    wide, labels = units.convert_columns(
        spark.createDataFrame([(value,)], f"{variable} double"), {variable: unit}
    )
    assert one(wide, variable) == pytest.approx(expected)
    assert labels[variable] == units.registries.TARGET_UNITS[variable]


def test_unknown_unit_fails(spark):
    df = spark.createDataFrame([("tas", "furlong", 1.0)], "variable string, unit string, value double")
    with pytest.raises(Exception, match="unknown unit furlong"):
        units.convert_units(df).collect()
    with pytest.raises(KeyError):
        units.convert_columns(df, {"tas": "furlong"})


def test_relabel_errors(spark):
    schema = "variable string, unit string, value double"
    for row, message in ((("nope", "K", 1.0), "variable not found"), (("tas", None, 1.0), "no unit for")):
        with pytest.raises(Exception, match=message):
            units.relabel_units(spark.createDataFrame([row], schema)).collect()


def test_input_units_are_checked(spark):
    grid = series(spark, [1.0], "pr")
    index = indices.get_index("r1mm").index
    units.check_inputs(grid, index, {"pr": "mm"})
    with pytest.raises(ValueError):
        units.check_inputs(grid, index, {"pr": "K"})
    with pytest.raises(KeyError):
        units.check_inputs(grid, indices.get_index("tx30").index)


def test_wind_speed(spark):
    df = spark.createDataFrame([(3.0, 4.0)], "u10 double, v10 double")
    out = units.wind_from_components(df)
    assert out.columns == ["sfcWind"] and one(out, "sfcWind") == 5.0


@pytest.mark.parametrize("days, kept", [(24, 0), (25, 1)])
def test_completeness_needs_four_fifths(spark, days, kept):
    grid = series(spark, [None] * days, "v")
    assert completeness.complete_periods(grid, (MONTHLY,)).count() == kept
    assert completeness.complete_cell_periods(grid, "v", MONTHLY).count() == 0


def test_completeness_fraction_is_checked(spark):
    with pytest.raises(ValueError):
        completeness.complete_periods(series(spark, [1.0], "v"), (MONTHLY,), valid_fraction=1.5)


def test_expected_counts(spark):
    rows = {r["freq"]: r["expected"] for r in calendar.expected_counts(spark).collect()}
    assert rows == {MONTHLY: 31, SEASONAL: 92, ANNUAL: 365, "W-MON": 7, "W": 7, "D": 1}
    rows = {r["freq"]: r["expected"] for r in calendar.expected_counts(spark, MONTHLY).collect()}
    assert rows == {MONTHLY: 1, SEASONAL: 3, ANNUAL: 12}


def test_frequency_inference(spark):
    assert completeness.require_frequency(series(spark, [1.0] * 10, "v")) == "D"
    gap = series(spark, [1.0] * 10, "v").where(F.dayofmonth("time") != 5)
    with pytest.raises(ValueError, match="irregular"):
        completeness.require_frequency(gap)


@pytest.mark.parametrize(
    "values, p, kind, expected",
    [
        ([1.0, 2.0, 4.0, 8.0, 16.0], 0.5, 1 / 3, 4.0),
        ([1.0, 2.0, 4.0, 8.0], 0.95, 1.0, 7.4),
        ([1.0, 2.0, 4.0, 8.0], 0.95, 1 / 3, 8.0),
        ([], 0.5, 1 / 3, None),
    ],
)
def test_quantiles(spark, values, p, kind, expected):
    df = spark.createDataFrame([(values,)], "v array<double>")
    got = one(df.select(numeric.plotting_quantile(F.col("v"), p, kind, kind).alias("q")), "q")
    assert got is None if expected is None else got == pytest.approx(expected)


def brute_doy(days, values, window, p):
    """Straight from the definition: pool the window of every target day by day of year."""
    before, after = window // 2, window - 1 - window // 2
    pools = {}
    for i, day in enumerate(days):
        pool = pools.setdefault(day.timetuple().tm_yday, [])
        pool += [v for v in values[max(0, i - before) : i + after + 1] if v is not None]
    out = {}
    for doy, pool in pools.items():
        pool.sort()
        n = len(pool)
        if not n:
            continue
        h = min(max(n * p + (1 + p) / 3, 1.0), float(n))
        j = int(h)
        out[doy] = pool[j - 1] + (h - j) * (pool[min(j, n - 1)] - pool[j - 1])
    return out


@pytest.mark.parametrize("window", [5, 6])
@pytest.mark.parametrize("years", [(2019, 2020), (2021, 2022)])
def test_day_of_year_percentile_by_brute_force(spark, window, years):
    first, last = D(years[0], 1, 3), D(years[1], 12, 30)
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    values = [None if i % 17 == 0 else float((i * 37) % 101) for i in range(len(days))]
    df = spark.createDataFrame(
        [(d, 1.0, 2.0, v) for d, v in zip(days, values)], "time date, lat double, lon double, v double"
    )
    want = brute_doy(days, values, window, 0.9)
    raw = percentiles.day_of_year_percentile(df, "v", 90, window, "none").collect()
    assert {r["doy"]: pytest.approx(r["q"]) for r in raw} == want
    got = {r["doy"]: r["q"] for r in percentiles.day_of_year_percentile(df, "v", 90, window).collect()}
    if max(d.timetuple().tm_yday for d in days) < 366:
        assert got == pytest.approx(want)
        return
    for t in range(1, 367):  # position of source day k is 1 + (k - 1) * 365 / 364
        x = 1 + (t - 1) * 364 / 365
        k = min(int(x), 364)
        assert got[t] == pytest.approx(want[k] + (x - k) * (want[k + 1] - want[k])), t


def test_share_above_percentile(spark):
    df = series(spark, [0.5, 2.0, 10.0], "pr")
    table = df.select("lat", "lon").distinct().select(
        F.lit(0).cast("bigint").alias("cell"), "lat", "lon", F.array_repeat(F.lit(5.0), 366).alias("qs")
    )
    context = IndexContext("pr", MONTHLY, {"wet": 1.0}, percentile=table)
    assert one(indices.share_above_percentile(df, context), "pr") == pytest.approx(10 / 12)
    dry = series(spark, [0.5, 1.0, 0.0], "pr")
    assert one(indices.share_above_percentile(dry, context), "pr") is None


def test_roll_up_equals_direct(spark):
    grid = series(spark, [float((i * 7) % 45) for i in range(800)], "tasmax")
    rolled = indices.count_indices(grid, ("tx30", "tx40"))
    for name in ("tx30", "tx40"):
        for freq in (MONTHLY, SEASONAL, ANNUAL):
            direct = indices.compute_index(grid, indices.get_index(name).index, freq)
            part = rolled.where((F.col("freq") == freq) & (F.col("index") == name))
            assert sorted(map(tuple, direct.collect())) == sorted(
                map(tuple, part.select("lat", "lon", "time", "value").collect())
            )


def test_result_does_not_depend_on_partitions(spark):
    grid = series(spark, [float((i * 13) % 50) for i in range(500)], "tasmin")
    index = indices.get_index("tr20").index
    results = [
        sorted(map(tuple, indices.compute_index(grid.repartition(n), index, SEASONAL).collect())) for n in (1, 7)
    ]
    assert results[0] == results[1]


def test_moving_mean_window(spark):
    out = quality.moving_mean(series(spark, [float(i) for i in range(20)], "v"), "v").orderBy("time").collect()
    assert out[10]["moving_mean"] == 9.5
    assert out[0]["moving_mean"] == 2.5  # rows 0..5
    few = quality.moving_mean(series(spark, [1.0] * 5, "v"), "v").collect()
    assert all(r["moving_mean"] is None for r in few)


def test_trend_needs_three_values(spark):
    line = quality.linear_trend(series(spark, [2.0 + i / 365.25 for i in range(100)], "v"), "v").first()
    assert line["slope"] == pytest.approx(1.0) and line["intercept"] == pytest.approx(2.0)
    assert quality.linear_trend(series(spark, [1.0, 2.0, None], "v"), "v").first()["slope"] is None


def test_season_window_without_wrap(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2021-01-01', DATE '2021-12-31')) AS time")

    def picked(window):
        return [r["time"] for r in days.where(window.contains(F.col("time"))).orderBy("time").collect()]

    got = picked(SeasonWindow((11, 15), (3, 10)))
    assert got[0] == D(2021, 3, 1) and got[-1] == D(2021, 11, 30) and len(got) == 10 + 16
    same = picked(SeasonWindow((5, 10), (5, 20)))
    assert len(same) == 31  # day >= 10 or day <= 20
    assert len(picked(SeasonWindow((11, 15), (3, 10), wrap=True))) == 16 + 31 + 59 + 10


def test_year_span_ends(daily):
    assert daily.where(YearSpan(2021, None).contains(F.col("time"))).count() == 365
    assert daily.where(YearSpan().contains(F.col("time"))).count() == 731
    with pytest.raises(ValueError):
        YearSpan(2021, None, strict=True).contains(F.col("time"))
    with pytest.raises(ValueError, match="outside the data"):
        completeness.reference_rows(daily, YearSpan(1990, 1991).contains(F.col("time")))


def test_index_errors(spark):
    grid = series(spark, [1.0], "tasmax")
    index = indices.get_index("tx30").index
    with pytest.raises(ValueError, match="not available"):
        indices.compute_index(grid, index.variant(freqs=(MONTHLY,)), ANNUAL)
    with pytest.raises(ValueError, match="unknown signature"):
        indices.compute_index(grid, index.variant(needs="other"), MONTHLY)
    with pytest.raises(ValueError, match="reference percentile"):
        indices.compute_index(grid, index.variant(needs="percentile"), MONTHLY)
    with pytest.raises(ValueError, match="neither"):
        indices.compute_index(grid, index.variant(direct=None), MONTHLY)
    with pytest.raises(KeyError):
        indices.get_index("nope")
    with pytest.raises(ValueError):
        resample.minimum_samples("W")
    assert indices.list_indices() == sorted(indices.AVAILABLE)
    assert index.variant(inputs=("a", "b")).multivariable and not index.multivariable
    assert Threshold(1, "le") == Threshold(1, "le") and PercentileSpec(95).window == 6


def test_combine_nothing_is_an_error():
    with pytest.raises(ValueError):
        combine.combine({})
    assert len(combine.valid_filters()) == 17


def test_upsert_keeps_one_row_per_key(spark, tmp_path):
    schema = "region_set string, region string, index string, time date, time_filter string, value double"
    month = [("NUTS-0", "R", "tx30", D(2024, 1, 1), "Jan", 1.0)]
    year = [("NUTS-0", "R", "tx30", D(2024, 1, 1), "Annual", 9.0)]
    path = str(tmp_path / "index")
    store.write_store(store.with_year(spark.createDataFrame(month, schema)), path, partition_by=["year"])
    for _ in range(2):
        store.update_store(spark, path, spark.createDataFrame(year, schema), incremental.INDEX_KEY)
    rows = {r["time_filter"]: r["value"] for r in spark.read.parquet(path).collect()}
    assert rows == {"Jan": 1.0, "Annual": 9.0} and spark.read.parquet(path).count() == 2
    # A label the store does not know is dropped when labels are aligned.
    store.update_store(
        spark, path, spark.createDataFrame([(*year[0][:4], "Odd", 1.0)], schema), incremental.INDEX_KEY, "time_filter"
    )
    assert spark.read.parquet(path).count() == 2


def test_store_errors(spark, tmp_path):
    df = series(spark, [1.0], "v")
    with pytest.raises(FileNotFoundError):
        store.update_store(spark, str(tmp_path / "none"), df, store.GRID_KEY)
    path = str(tmp_path / "grid")
    assert store.write_store(df, path) and not store.write_store(df, path)
    with pytest.raises(ValueError, match="not in the store"):
        store.read_store(spark, path, "missing")


@pytest.mark.parametrize(
    "dims, n, expected",
    [
        (["region", "time"], 100, {"region": 1, "time": -1}),
        (["region", "time"], 500, {"region": 50, "time": -1}),
        (["combined"], 0, {"combined": -1}),
        (["time", "lat", "lon"], 0, {"time": 1000, "lat": 100, "lon": 100}),
        (["time", "time_filter", "region"], 400, {"region": 1, "time": -1, "time_filter": 1}),
    ],
)
def test_layout(dims, n, expected):
    assert store.layout(dims, n) == expected


def test_manifest_days(spark):
    schema = "variable string, level string, start date, end date, grain string"
    rows = [("tasmax", None, D(2024, 1, 1), D(2024, 1, 3), "daily")]
    out = manifest.requests(spark.createDataFrame(rows, schema), "/d", area=(75, -30, 30, 50)).collect()
    assert len(out) == 3 and {tuple(r["days"]) for r in out} == {("01",), ("02",), ("03",)}
    assert out[0]["request_names"] == ["maximum_2m_temperature_since_previous_post_processing"]
    assert out[0]["area"] == [75.0, -30.0, 30.0, 50.0] and out[0]["pressure_level"] is None


@pytest.mark.parametrize("compat, months", [(True, ["02"]), (False, ["01", "02"])])
def test_manifest_start_inside_a_month(spark, compat, months):
    schema = "variable string, level string, start date, end date, grain string"
    rows = [("tas", None, D(2024, 1, 15), D(2024, 2, 10), "monthly")]
    out = manifest.requests(spark.createDataFrame(rows, schema), "/d", compat=compat).orderBy("file").collect()
    assert [r["months"][0] for r in out] == months
    assert out[-1]["last_day"] == D(2024, 2, 10) and len(out[-1]["days"]) == 29


PATHS = {
    "/lake/raw/OBS/pr/None/1987/pr_None_OBS_19870630.nc": ("daily", None, None),
    "/lake/raw/OBS/ta/850/1999/ta850_850_OBS_19991231.nc": ("daily", "850", None),
    "/lake/raw/OBS/pr/None/2004/pr_None_OBS_01022004-29022004.nc": ("monthly", None, None),
    "/lake/raw/OBS/pr/None/2004/pr_None_OBS_01012004-31122004.nc": ("yearly", None, None),
    "pr_None_OBS_19870630.nc": (None, None, "path structure"),
    "/lake/raw/OBS/pr/None/1987/notes.nc": (None, None, "file name structure"),
    "/lake/raw/OBS/pr/None/1987/tas_None_OBS_19870630.nc": (None, None, "variable mismatch"),
    "/lake/raw/OBS/pr/None/1987/pr_None_SIM_19870630.nc": (None, None, "dataset mismatch"),
    "/lake/raw/OBS/pr/None/2004/pr_None_OBS_03022004-29022004.nc": (None, None, "grain of date range"),
    "/lake/raw/OBS/pr/None/2004/pr_None_OBS_0102-2902.nc": (None, None, "date range format"),
    "/lake/raw/OBS/pr/None/2004/pr_None_OBS_june.nc": (None, None, "date format"),
}


def test_parse_paths(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    got = {
        r["path"]: (r["p"]["grain"], r["p"]["level"], r["p"]["error"])
        for r in df.select("path", naming.parse_path(F.col("path")).alias("p")).collect()
    }
    assert got == PATHS


def test_date_tokens(spark):
    df = spark.createDataFrame([(D(2023, 5, 20), g) for g in naming.GRAINS], "d date, g string")
    tokens = {r["g"]: r["t"] for r in df.select("g", naming.date_token(F.col("d"), F.col("g")).alias("t")).collect()}
    assert tokens == {"daily": "20230520", "monthly": "01052023-31052023", "yearly": "01012023-31122023"}
    with pytest.raises(Exception, match="unsupported grain"):
        df.select(naming.date_token(F.col("d"), F.lit("hourly"))).collect()


def test_listing(spark):
    df = spark.createDataFrame([(p,) for p in ("s3://b/file1.nc", "s3://b/file2.zarr", "s3://b/other.nc")], "path string")
    assert catalog.select_paths(df, suffix=".nc").count() == 2
    assert catalog.select_paths(df, pattern="file*").count() == 2
    assert catalog.select_paths(df, suffix=".nc", pattern="file?.*").count() == 1
    assert text.glob_to_regex("a[!0-9]*.nc") == "^a[^0-9].*\\.nc$"


def test_rows_of_tables_in_parts(spark, tmp_path):
    """A table is one entry, as a file or a folder of files, and one without rows has none."""
    spark.range(30).repartition(3).write.parquet(str(tmp_path / "root" / "labels.parquet"))
    spark.range(5).repartition(2).write.parquet(str(tmp_path / "root" / "or ders+1.parquet"))
    spark.range(0).write.parquet(str(tmp_path / "root" / "lineitem.parquet"))
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "root" / "events.parquet"))
    one = next((tmp_path / "root" / "events.parquet").glob("part-*.parquet"))
    shutil.copy(one, tmp_path / "root" / "one.parquet")
    queries.load_all()
    rows = queries.QUERIES["s3_rows_of_listed_files"](spark, str(tmp_path / "root")).collect()
    assert {r["name"]: r["n"] for r in rows} == {"labels.parquet": 30, "or ders+1.parquet": 5, "lineitem.parquet": 0, "one.parquet": 7}


def test_required_stores(spark):
    required = catalog.required_stores(spark, ["tx30", "r1mm"])
    have = spark.createDataFrame([("pr_None_ERA5_gridded.zarr",)], "name string")
    with pytest.raises(FileNotFoundError, match="tasmax_None_ERA5_gridded.zarr"):
        catalog.require_stores(required, have)


def test_all_missing_stores_are_named(spark):
    names = [(f"store{i:02}",) for i in range(25)]
    required = spark.createDataFrame(names, "name string")
    with pytest.raises(FileNotFoundError, match="25 missing stores.*store24"):
        catalog.require_stores(required, required.limit(0))


def test_lines_without_run(spark):
    rows = [(0, "a"), (1, None), (2, "a")]
    entries = spark.createDataFrame(rows, "line_no long, request_id string")
    assert [r["line_no"] for r in runlog.unassigned(entries).collect()] == [1]


def test_schemes_with_both_kinds_of_coordinates(spark):
    for names in ("rlon rlat longitude latitude", "i j longitude latitude", "i j lon lat"):
        df = spark.createDataFrame([(D(2020, 1, 1), 1.0, 2.0, 3.0, 4.0, 5.0)], ["time", *names.split(), "field"])
        assert set(canon.canonicalise(df, "tas").columns) == {"time", "x", "y", "lon", "lat", "tas"}


def test_unfinished_write_is_no_store(spark, tmp_path):
    path = str(tmp_path / "s")
    (tmp_path / "s" / "_temporary").mkdir(parents=True)
    assert not store.exists(spark, path)
    assert store.write_store(spark.range(3), path) and store.exists(spark, path)
    assert not store.write_store(spark.range(3), path)


def test_stored_region_tile_stays(spark):
    df = spark.createDataFrame([("s", f"r{i:04}") for i in range(450)], "region_set string, region string")
    assert store.with_region_tiles(df, 1).agg(F.max("tile_region")).first()[0] == 449
    assert store.with_region_tiles(df).agg(F.max("tile_region")).first()[0] == 8


def log(spark, *entries):
    lines = [
        (i, '{"request_id": "r", "action": "%s", "action_id": %s}' % (a, f'"{n}"' if n else "null"))
        for i, (a, n) in enumerate(entries)
    ]
    return runlog.parse_lines(spark.createDataFrame(lines, "line_no bigint, line string"))


@pytest.mark.parametrize("bucket", [1, 2, 100])
def test_action_spans(spark, bucket):
    good = log(spark, ("/create", "a1"), ("/x", None), ("/create_end", None), ("/y", None), ("/create", "a2"))
    spans = {r["action_id"]: r for r in runlog.action_spans(good, bucket).collect()}
    assert spans["a1"]["n_lines"] == 3 and spans["a1"]["closed"] and not spans["a1"]["malformed"]
    assert spans["a2"]["n_lines"] == 1 and not spans["a2"]["closed"]
    nested = log(spark, ("/create", "a1"), ("/create_end", None), ("/create", "a2"), ("/create", "a3"))
    with pytest.raises(Exception, match="malformed log at line 3"):
        runlog.require_well_formed(runlog.action_spans(nested, bucket)).collect()
    with pytest.raises(Exception, match="malformed log at line 0"):
        runlog.require_well_formed(runlog.action_spans(log(spark, ("/create", None)), bucket)).collect()


@pytest.mark.parametrize("bucket", [1, 3, 100])
def test_latest_runs(spark, bucket):
    ids = ["a", "a", "b", "a", "c", "c", "b"]
    lines = [(i, '{"request_id": "%s", "action": "/s"}' % r) for i, r in enumerate(ids)] + [(99, "   ")]
    entries = runlog.parse_lines(spark.createDataFrame(lines, "line_no bigint, line string"))
    got = sorted((r["request_id"], r["line_no"]) for r in runlog.latest_runs(entries, bucket).collect())
    assert got == [("a", 3), ("b", 6), ("c", 4), ("c", 5)]


def test_log_errors(spark):
    lines = spark.createDataFrame([(7, "{oops")], "line_no bigint, line string")
    with pytest.raises(Exception, match="Error parsing line 7"):
        runlog.parse_lines(lines).collect()
    with pytest.raises(ValueError, match="no entries found"):
        runlog.values_for_key(log(spark, ("/x", None)), "input_args", required=True)


def test_default_end():
    assert incremental.default_end(D(2024, 3, 31)) == D(2024, 2, 29)
    assert incremental.default_end(D(2024, 1, 1)) == D(2023, 12, 31)


def test_up_to_date_index_is_left_alone(spark):
    periods = spark.createDataFrame([("MS", D(2024, 1, 1)), ("MS", D(2024, 2, 1))], "freq string, time date")
    points = spark.createDataFrame([("MS", D(2024, 2, 1))], "freq string, last_period date")
    assert incremental.due_from(periods, points).count() == 0
    assert incremental.due_from(periods, points, refresh=True).first()["due"] == D(2024, 2, 1)


def test_open_ring_edges(spark):
    df = spark.createDataFrame(
        [([[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]],)], "rings array<array<struct<x:double,y:double>>>"
    )
    assert one(df.select(F.size(geometry.edges(F.col("rings"))).alias("n")), "n") == 3
