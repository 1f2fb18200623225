"""Reference state beside a grid: equal to the whole history, and what updates read with it."""

import datetime as dt

import pytest
from gridclim.operators import indices, percentiles, regions
from gridclim.plans import derived_index, incremental, index_run
from gridclim.plans.reference import Reference
from gridclim.session import scratch_dir
from gridclim.sources import store
from pyspark.sql import functions as F

FIRST = dt.date(1999, 2, 10)


@pytest.fixture(scope="module")
def grid(spark):
    """Three cells over two years without gaps; one falls silent, one lacks rows."""
    day = F.date_add(F.lit(FIRST), F.col("id").cast("int"))
    cells = F.explode(F.array(*[F.struct(F.lit(la).alias("lat"), F.lit(lo).alias("lon")) for la, lo in ((50.0, 5.0), (50.0, 6.0), (51.0, 5.0))]))
    rows = spark.range(760).select(day.alias("time"), F.col("id"), cells.alias("c")).select("time", "id", "c.*")
    value = F.pmod(F.xxhash64("id", "lat", "lon"), F.lit(400)) / 10
    rows = rows.withColumn("pr", F.when((F.col("lon") == 5) | (F.col("id") < 300), value)).withColumn("tasmax", value)
    return rows.where((F.col("lat") == 50) | (F.col("id") % 7 > 0)).drop("id").cache()


def stored(grid, until):
    path = scratch_dir(grid.sparkSession)
    store.write_store(store.with_year(grid.where(F.col("time") <= F.lit(until))), path, "overwrite", ["year"])
    return path


def table(df):
    return {(r["lat"], r["lon"]): [None if v is None else round(v, 9) for v in r["qs"]] for r in df.collect()}


@pytest.mark.parametrize("stops", [[], ["1999-12-30"], ["2000-02-27", "2000-02-29", "2000-12-31", "2001-01-02"]])
def test_extended_state_equals_whole_history(spark, grid, stops):
    state = Reference(spark, scratch_dir(spark), ("r95ptot", "tx30"))
    for k, until in enumerate([*stops, "2001-03-10"]):
        now = grid.where(F.col("time") <= until)
        assert state.extend(now, now.select("time")) == ("extended" if k else "base")
        assert state.extend(now, now.select("time")) == "current"
        assert table(state.percentiles("r95ptot")) == table(percentiles.day_of_year_table(now, "pr", 95))
    ever = {r["cell"]: (r["has_pr"], r["has_tasmax"]) for r in state.presence().collect()}
    assert len(ever) == 3 and all(a and b for a, b in ever.values())


def test_days_in_between_make_a_new_base(spark, grid):
    state = Reference(spark, scratch_dir(spark), ("r95ptot",))
    hole = grid.where("time NOT BETWEEN '1999-05-01' AND '1999-05-03'")
    assert state.extend(hole, hole.select("time")) == "base"
    assert state.extend(grid, grid.select("time")) == "base"
    assert table(state.percentiles("r95ptot")) == table(percentiles.day_of_year_table(grid, "pr", 95))


def test_parts_that_broke_are_not_read(spark, grid):
    path = scratch_dir(spark)
    state = Reference(spark, path, ("r95ptot",))
    some = grid.where("time < '2000-06-01'")
    state.extend(some, some.select("time"))
    want = table(state.percentiles("r95ptot"))
    spark.read.parquet(f"{path}-reference/r95ptot/version=0").write.parquet(f"{path}-reference/r95ptot/version=1")
    assert table(state.percentiles("r95ptot")) == want
    assert state.extend(grid, grid.select("time")) == "extended"
    assert table(state.percentiles("r95ptot")) == table(percentiles.day_of_year_table(grid, "pr", 95))


def test_months(spark, grid):
    state = Reference(spark, scratch_dir(spark), ("r95ptot",))
    state.extend(grid, grid.select("time"))
    whole, some = (table(state.percentiles("r95ptot", m)) for m in (None, {4, 5, 6}))
    for cell, qs in whole.items():
        assert some[cell][130:150] == qs[130:150]


def test_an_update_reads_due_years_only(spark, grid):
    """Equal to a full run, with the older years of the grid out of reach."""
    names = ("r95ptot", "tx30")
    xwalk = regions.cells_of(grid).select("lat", "lon", F.lit("NUTS-0").alias("region_set"), F.lit("A").alias("region"), F.lit(1.0).alias("w")).cache()
    path, out = stored(grid, "2000-11-30"), scratch_dir(spark)
    state = Reference(spark, path, names)
    old = spark.read.parquet(path)
    index_run.run(spark, out, old, xwalk, names, sample="D", days=old.select("time").distinct(), reference=state)
    new = stored(grid, "2001-02-28")
    whole = spark.read.parquet(new)
    days = whole.select("time").distinct()
    state.extend(whole, days)
    due = incremental.due_periods(incremental.index_labels(spark.read.parquet(out)), days, xwalk, names)
    first = due.agg(F.min("period")).first()[0]
    months = incremental.reference_months(days.where(F.col("time") >= F.lit(first)))
    assert first.year == 2000 and months >= {1, 2, 11, 12}
    # A grid that has nothing but the due years gives the same.
    rest = stored(grid.where(F.year("time") >= first.year), "2001-02-28")
    about = index_run.index_journal(spark, out)
    assert incremental.update_index(spark, out, spark.read.parquet(rest), xwalk, names, journal=about, days=days, reference=state)
    assert index_run.run(spark, out, whole, xwalk, names, sample="D", days=days, reference=state) == dict.fromkeys(names, "current")
    full = derived_index.regional_indices(grid.where("time <= '2001-02-28'"), xwalk, names)
    key = ["region_set", "region", "index", "time", "time_filter"]
    got, want = (
        {tuple(r[k] for k in key): None if r["value"] is None else round(r["value"], 9) for r in df.collect() if r["period"] > dt.date(2000, 11, 1)}
        for df in (spark.read.parquet(out), full)
    )
    assert got == want and len(got) > 4
    assert indices.get_index("r95ptot").index.percentile.window == percentiles.WINDOW


def test_percentiles_come_from_the_state_alone(spark, monkeypatch):
    """No index is computed for them."""
    from gridclim import queries
    from gridclim.queries import updates

    queries.load_all()
    monkeypatch.setattr(updates.index_run, "run", None)
    assert queries.QUERIES["a16_percentile_from_kept_state"](spark, "/root/testdata/sf0.001").count() > 0
