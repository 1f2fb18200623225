"""Incremental runs and their streaming twin."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import CELL
from ..functions import calendar
from ..model import DAILY
from ..operators import regions
from ..plans import derived_index, incremental, index_run, ingest, reference
from ..session import scratch_dir
from ..sources import journal, metadata, store, tables
from ..streaming import daily
from . import query
from . import sql as q
from .aggregations import _COMBINED, DAILY_SQL, DOY, STRETCH
from .common import big, r6, text, xwalk
from .sinks import _META, _map, _meta

def _end(grid):
    return grid.agg(F.max("time")).first()[0]


@query(
    "i1_update_grid",
    q.with_(q.GRID)
    + """SELECT lat, lon, count(*) AS n, round(sum(pr), 6) AS pr, CAST(max(time) AS VARCHAR) AS last FROM grid
    GROUP BY 1, 2""",
)
def i1(spark, sf):
    path = scratch_dir(spark)
    grid = tables.grid_daily(spark, sf).select("time", *CELL, "pr")
    store.write_store(store.with_year(grid.where(F.col("time") <= "1999-04-10")), path, partition_by=["year"])
    incremental.update_grid(spark, path, grid, dt.date(2000, 2, 29))
    incremental.update_grid(spark, path, grid, _end(grid))
    incremental.update_grid(spark, path, grid, _end(grid))  # up to date, nothing happens
    return spark.read.parquet(path).groupBy(*CELL).agg(
        F.count("*").alias("n"), r6(F.sum("pr")).alias("pr"), text(F.max("time")).alias("last")
    )


_REGIONAL = (
    q.with_(q.GRID, q.XWALK)
    + """, d AS (SELECT region_set, region, time, sum(pr * w) / sum(w) AS pr FROM grid JOIN xwalk USING (lat, lon)
      GROUP BY 1, 2, 3)
    SELECT region_set, region, count(*) AS n, round(sum(pr), 5) AS pr, CAST(max(time) AS VARCHAR) AS last FROM d GROUP BY 1, 2"""
)


def _regional_totals(df):
    return df.groupBy("region_set", "region").agg(
        F.count("*").alias("n"), F.round(F.sum("pr"), 5).alias("pr"), text(F.max("time")).alias("last")
    )


@query("i2_update_regions", _REGIONAL)
def i2(spark, sf):
    path, table = scratch_dir(spark), xwalk(spark, sf)
    grid = tables.grid_daily(spark, sf).select("time", *CELL, "pr")
    # Each set was left at another day, and NUTS-3 was never written.
    stops = F.create_map(*[F.lit(v) for v in ("NUTS-0", "1999-12-31", "NUTS-1", "2000-03-10", "NUTS-2", "2001-06-30")])
    means = regions.aggregate_days(grid, table, ["pr"])
    old = means.where(F.col("time") <= F.to_date(F.try_element_at(stops, F.col("region_set"))))
    store.write_store(store.with_year(old), path, partition_by=["year"])
    incremental.update_regions(spark, path, grid, table, ["pr"], _end(grid))
    incremental.update_regions(spark, path, grid, table, ["pr"], _end(grid))
    return _regional_totals(spark.read.parquet(path))


@query("i2_ingest_stores", _REGIONAL)
def i2_ingest(spark, sf):
    root = scratch_dir(spark)
    grid, outlines = tables.grid_daily(spark, sf), tables.regions(spark, sf)
    ingest.ingest(spark, grid, outlines, root, ["pr"], dt.date(2000, 1, 31))
    ingest.ingest(spark, grid, outlines, root, ["pr"], _end(grid))
    return _regional_totals(spark.read.parquet(f"{root}/regional"))


_INDEX_SQL = _COMBINED.rstrip() + ", " + q.XWALK + """
  SELECT region_set, region, index, CAST(time AS VARCHAR) AS time, time_filter, round(sum(value * w) / sum(w), 6) AS value
  FROM combined JOIN xwalk USING (lat, lon) GROUP BY 1, 2, 3, 4, 5"""
_NAMES = ("tx35", "fd", "r20mm")


_THREE = _INDEX_SQL.replace(
    "FROM combined JOIN", "FROM (SELECT * FROM combined WHERE index IN ('tx35', 'fd', 'r20mm')) JOIN"
)


def _updated_index(spark, sf, stop, refresh):
    path, table = scratch_dir(spark), xwalk(spark, sf)
    grid = tables.grid_daily(spark, sf)
    early = grid.where(F.col("time") <= stop)
    first = derived_index.regional_indices(early, table, _NAMES)
    store.write_store(store.with_year(first), path, partition_by=["year"])
    incremental.update_index(spark, path, grid, table, _NAMES, refresh=refresh)
    stored = spark.read.parquet(path)
    return stored.select(
        "region_set", "region", "index", text("time").alias("time"), "time_filter", r6("value").alias("value")
    )


@query("i3_update_index", _THREE)
def i3(spark, sf):
    return _updated_index(spark, sf, "2000-08-31", False)


@query("i3_update_index_refresh", _THREE)
def i3_refresh(spark, sf):
    # Stops inside a season that already counts as complete.
    return _updated_index(spark, sf, "2000-08-20", True)


def _caught_up(spark, sf, kept, names=_NAMES, grid=None):
    """A store that holds only the rows ``kept`` selects, then brought up to date."""
    path, table = scratch_dir(spark), xwalk(spark, sf)
    grid = tables.grid_daily(spark, sf) if grid is None else grid
    full = derived_index.regional_indices(grid, table, names)
    store.write_store(store.with_year(full.where(kept)), path, partition_by=["year"])
    incremental.update_index(spark, path, grid, table, _NAMES)
    return spark.read.parquet(path).select(
        "region_set", "region", "index", text("time").alias("time"), "time_filter", r6("value").alias("value")
    )


@query("i3_new_index_added", _THREE)
def i3_new_index(spark, sf):
    return _caught_up(spark, sf, F.lit(True), ("tx35", "fd"))


@query("i3_lagging_region_set", _THREE)
def i3_lagging(spark, sf):
    return _caught_up(spark, sf, (F.col("region_set") != "NUTS-2") | (F.col("period") <= "1999-06-30"))


@query("i3_interrupted_commit", _THREE)
def i3_interrupted(spark, sf):
    # The newest years were swapped in, the one before them was not.
    return _caught_up(spark, sf, F.year("time") != 2000)


_SILENT = "lat = 30 AND time > DATE '2000-06-30'"
_SILENT_GRID = q.GRID.replace("grid AS (", "everything AS (", 1) + f""", grid AS (
  SELECT time, lat, lon, tas, CASE WHEN NOT ({_SILENT}) THEN tasmin END AS tasmin,
    CASE WHEN NOT ({_SILENT}) THEN tasmax END AS tasmax, CASE WHEN NOT ({_SILENT}) THEN pr END AS pr FROM everything)"""


@query("i3_cell_without_recent_values", _THREE.replace(q.GRID, _SILENT_GRID))
def i3_silent(spark, sf):
    gone = F.expr(_SILENT)
    grid = tables.grid_daily(spark, sf).withColumns(
        {v: F.when(~gone, F.col(v)) for v in ("tasmin", "tasmax", "pr")}
    )
    return _caught_up(spark, sf, F.col("period") <= "2000-08-31", grid=grid)


@query(
    "i1_interrupted_commit",
    q.with_(q.GRID)
    + """SELECT lat, lon, count(*) AS n, round(sum(pr), 6) AS pr, CAST(max(time) AS VARCHAR) AS last FROM grid
    GROUP BY 1, 2""",
)
def i1_interrupted(spark, sf):
    path = scratch_dir(spark)
    grid = tables.grid_daily(spark, sf).select("time", *CELL, "pr")
    store.write_store(store.with_year(grid.where(F.year("time") != 2000)), path, partition_by=["year"])
    incremental.update_grid(spark, path, grid, _end(grid))
    return spark.read.parquet(path).groupBy(*CELL).agg(
        F.count("*").alias("n"), r6(F.sum("pr")).alias("pr"), text(F.max("time")).alias("last")
    )


@query(
    "i4_update_attributes",
    q.with_(_META)
    + q.union(
        *[
            f"SELECT dataset, '{k}' AS key, {v} AS value FROM m"
            for k, v in {
                "dcterms:created": "'then'",
                "dcterms:valid": "start_date || '/' || end_date",
                "dcterms:temporal": "'start=' || start_date || '; end=' || end_date",
                "dc:title": "'new title'",
                "last_checkpoint_MS": "end_date",
                "last_checkpoint_YS": "start_date",
                "brand": "p_brand",
            }.items()
        ]
    ),
)
def i4(spark, sf):
    lit, meta = F.lit, _meta(spark, sf)
    old = _map(
        dcterms__created=lit("then"), dcterms__valid=F.concat(F.col("start_date"), lit("/x")), dc__title=lit("old"),
        last_checkpoint_MS=F.col("start_date"), last_checkpoint_YS=F.col("start_date"), brand=F.col("p_brand"),
        start_date=lit("legacy"),
    )
    new = _map(
        dcterms__created=lit("now"), dcterms__valid=F.concat(lit("y/"), "end_date"), dc__title=lit("new title"),
        last_checkpoint_MS=F.col("end_date"), other=lit("ignored"),
    )
    merged = incremental.merge_attributes(
        meta.select("dataset", old.alias("attrs")), meta.select("dataset", new.alias("attrs"))
    )
    return metadata.as_rows(merged)


@query(
    "i5_default_end",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT CAST(d AS VARCHAR) AS today, CAST(CAST(date_trunc('month', d) AS DATE) - 1 AS VARCHAR) AS last FROM d""",
)
def i5(spark, sf):
    days = tables.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return days.select(text("d").alias("today"), text(calendar.default_end(F.col("d"))).alias("last"))


def _finished(spark, sf):
    path, checkpoint = scratch_dir(spark), scratch_dir(spark)
    schema = tables.table(spark, sf, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    stream = daily.daily_statistics_stream(tables.sub_daily(spark, raw))
    daily.write_available(stream, path, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query(
    "i6_daily_stream",
    DAILY_SQL.replace(
        "round(value, 6) AS value FROM daily",
        "round(value, 6) AS value FROM daily WHERE time + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY",
    ),
)
def i6(spark, sf):
    out = _finished(spark, sf)
    return out.select(*CELL, "variable", text("time").alias("time"), "n", r6("value").alias("value"))


@query(
    "i6_upsert_stream",
    q.with_(q.GRID) + "SELECT lat, year(time) AS year, count(*) AS n, round(sum(pr), 6) AS pr FROM grid GROUP BY 1, 2",
)
def i6_upsert(spark, sf):
    landing, path = scratch_dir(spark), scratch_dir(spark)
    grid = tables.grid_daily(spark, sf).select("time", *CELL, "pr")
    cut = F.col("time") <= "1999-12-31"
    store.write_store(grid.where(cut), landing)
    for part in (None, grid.where(~cut)):
        if part is not None:
            store.write_store(part, landing, "append")
        stream = spark.readStream.schema(grid.schema).parquet(landing)
        daily.upsert_available(stream, path, path + "-progress", store.GRID_KEY).awaitTermination()
    return spark.read.parquet(path).groupBy("lat", big("year").alias("year")).agg(
        F.count("*").alias("n"), r6(F.sum("pr")).alias("pr")
    )



# --- what datasets say about themselves ---------------------------------------------------

_THEN, _NOW = "2024-01-01T00:00:00Z", "2024-02-01T00:00:00Z"


def _fields(frame: str, dataset: str, fields: dict[str, str]) -> str:
    return q.union(*[f"SELECT {dataset} AS dataset, '{k}' AS key, {v} AS value FROM {frame}" for k, v in fields.items()])


def _stored(attributes, keys):
    rows = metadata.as_rows(attributes)
    return rows.where(F.col("key").isin(list(keys)) | F.col("key").startswith("last_checkpoint_"))


_SPAN = {
    "dcterms:created": f"'{_THEN}'",
    "dcterms:modified": f"'{_NOW}'",
    "dcterms:valid": "a || '/' || b",
    "dcterms:temporal": "'start=' || a || '; end=' || b",
    "dc:coverage": "'Europe; ' || substr(a, 1, 4) || '-' || substr(b, 1, 4)",
}


@query(
    "k11_stored_grid_attributes",
    q.with_(q.GRID)
    + """, s AS (SELECT strftime(min(time), '%Y-%m-%d') AS a, strftime(max(time), '%Y-%m-%d') AS b,
        max(lat) AS n, min(lon) AS w, min(lat) AS s, max(lon) AS e FROM grid),
      v AS (SELECT * FROM s, (VALUES ('pr'), ('tas')) AS t(variable)) """
    + _fields("v", "variable", {
        **_SPAN, "dcterms:spatial": "'westlimit=' || w || ', eastlimit=' || e || ', southlimit=' || s || ', northlimit=' || n"
    }),
)
def k11_grid(spark, sf):
    root = scratch_dir(spark)
    grid, outlines = tables.grid_daily(spark, sf), tables.regions(spark, sf)
    ingest.ingest(spark, grid, outlines, root, ["pr", "tas"], dt.date(2000, 1, 31), now=_THEN)
    ingest.ingest(spark, grid, outlines, root, ["pr", "tas"], _end(grid), now=_NOW)
    stored = ingest.grid_journal(spark, root, ["pr", "tas"]).attributes()
    return _stored(stored, [*_SPAN, "dcterms:spatial"])


@query(
    "k3_stored_regional_attributes",
    q.with_(q.GRID, q.XWALK)
    + """, s AS (SELECT region_set, strftime(min(time), '%Y-%m-%d') AS a, strftime(max(time), '%Y-%m-%d') AS b
      FROM grid, (SELECT DISTINCT region_set FROM xwalk) GROUP BY 1) """
    + _fields("s", "'pr/' || region_set", _SPAN),
)
def k3_regional(spark, sf):
    root = scratch_dir(spark)
    grid, outlines = tables.grid_daily(spark, sf), tables.regions(spark, sf)
    ingest.ingest(spark, grid, outlines, root, ["pr"], dt.date(2000, 1, 31), now=_THEN)
    ingest.ingest(spark, grid, outlines, root, ["pr"], _end(grid), now=_NOW)
    return _stored(ingest.regional_journal(spark, root, ["pr"]).attributes(), _SPAN)


_INDEX_ATTRIBUTES = (
    _COMBINED
    + ", "
    + q.XWALK
    + """, c AS (SELECT * FROM combined, (SELECT DISTINCT region_set FROM xwalk) WHERE index IN ('tx35', 'fd', 'r20mm')),
      s AS (SELECT index, region_set, strftime(min(time), '%Y-%m-%d') AS a, strftime(max(time), '%Y-%m-%d') AS b,
        max(period) FILTER (freq = 'MS') AS ms, max(period) FILTER (freq = 'QS-DEC') AS qs, max(period) FILTER (freq = 'YS') AS ys
        FROM c GROUP BY 1, 2) """
)
_POINTS = {
    f"last_checkpoint_{f}": f"strftime({c}, '%Y-%m-%dT00:00:00')" for f, c in (("MS", "ms"), ("QS-DEC", "qs"), ("YS", "ys"))
}


def _run_twice(spark, sf):
    """An index store written up to a day, then brought up to the end of the grid."""
    path, table = scratch_dir(spark), xwalk(spark, sf)
    grid = tables.grid_daily(spark, sf)
    early = grid.where(F.col("time") <= "2000-08-31")
    first = index_run.run(spark, path, early, table, _NAMES, now=_THEN, sources=("era5/tasmax", "era5/pr"), sample=DAILY)
    second = index_run.run(spark, path, grid, table, _NAMES, now=_NOW, sources=("era5/tasmax", "era5/pr"), sample=DAILY)
    assert set(first.values()) == {"written"} and set(second.values()) == {"updated"}, (first, second)
    return path


@query(
    "i4_stored_attributes",
    _INDEX_ATTRIBUTES
    + _fields("s", "index || '/' || region_set", {
        **{k: v for k, v in _SPAN.items() if k != "dc:coverage"}, **_POINTS, "frequencies_used": "'MS, QS-DEC, YS'",
        "dc:source": "'Copernicus Climate Data Store (https://doi.org/10.24381/cds.4991cf48); Derived from: era5/tasmax; era5/pr'",
    }),
)
def i4_stored(spark, sf):
    stored = index_run.index_journal(spark, _run_twice(spark, sf)).attributes()
    return _stored(stored, [*(k for k in _SPAN if k != "dc:coverage"), "frequencies_used", "dc:source"])


@query("a25_stored_checkpoints", _INDEX_ATTRIBUTES + _fields("s", "index || '/' || region_set", _POINTS))
def a25_stored(spark, sf):
    return _stored(index_run.index_journal(spark, _run_twice(spark, sf)).attributes(), [])


@query("i3_index_run", _THREE)
def i3_run(spark, sf):
    return spark.read.parquet(_run_twice(spark, sf)).select(
        "region_set", "region", "index", text("time").alias("time"), "time_filter", r6("value").alias("value")
    )


@query("a34_run_by_stored_attributes", _THREE)
def a34_run(spark, sf):
    """An index that no attribute names yet is computed in full, the others are updated."""
    path, table = scratch_dir(spark), xwalk(spark, sf)
    grid = tables.grid_daily(spark, sf)
    index_run.run(spark, path, grid.where(F.col("time") <= "2000-08-31"), table, ("tx35", "fd"), now=_THEN, sample=DAILY)
    done = index_run.run(spark, path, grid, table, _NAMES, now=_NOW, sample=DAILY)
    assert done == {"tx35": "updated", "fd": "updated", "r20mm": "written"}, done
    return spark.read.parquet(path).select(
        "region_set", "region", "index", text("time").alias("time"), "time_filter", r6("value").alias("value")
    )


@query(
    "i1_open_commit",
    q.with_(q.GRID)
    + """SELECT lat, lon, count(*) AS n, round(sum(pr), 6) AS pr, CAST(max(time) AS VARCHAR) AS last FROM grid
    GROUP BY 1, 2""",
)
def i1_open(spark, sf):
    """A run that recorded two years, swapped in one of them and broke; the next one completes it."""
    root = scratch_dir(spark)
    grid = tables.grid_daily(spark, sf).select("time", *CELL, "pr")
    about = ingest.grid_journal(spark, root, ["pr"], _THEN)
    journal.create(about, store.with_year(grid.where(F.year("time") < 2000)))
    about.begin([2000, 2001])
    swapped = store.with_year(grid.where(F.year("time") == 2001))
    swapped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(about.path)
    incremental.update_grid(spark, about.path, grid, _end(grid), about)
    return spark.read.parquet(about.path).groupBy(*CELL).agg(
        F.count("*").alias("n"), r6(F.sum("pr")).alias("pr"), text(F.max("time")).alias("last")
    )


@query(
    "s8_stored_profile",
    q.with_(q.GRID)
    + """, s AS (SELECT strftime(min(time), '%Y-%m-%d') AS a, strftime(max(time), '%Y-%m-%d') AS b FROM grid)
    SELECT * FROM (VALUES ('*', 'variable', 'pr', 'double'), ('*', 'variable', 'tas', 'double')) AS t(dataset, kind, name, value)
    UNION ALL SELECT '*', 'coordinate', 'time', CAST(count(DISTINCT time) AS VARCHAR) FROM grid
    UNION ALL SELECT '*', 'coordinate', 'lat', CAST(count(DISTINCT lat) AS VARCHAR) FROM grid
    UNION ALL SELECT '*', 'coordinate', 'lon', CAST(count(DISTINCT lon) AS VARCHAR) FROM grid
    UNION ALL SELECT v, 'attribute', 'dcterms:valid', a || '/' || b FROM s, (VALUES ('pr'), ('tas')) AS t(v)
    UNION ALL SELECT v, 'attribute', 'dc:language', 'en' FROM s, (VALUES ('pr'), ('tas')) AS t(v)""",
)
def s8_stored(spark, sf):
    root = scratch_dir(spark)
    grid = tables.grid_daily(spark, sf).select("time", *CELL, "pr", "tas")
    about = ingest.grid_journal(spark, root, ["pr", "tas"], _NOW, cells=grid)
    journal.create(about, store.with_year(grid))
    shown = F.col("name").isin("dcterms:valid", "dc:language") | (F.col("kind") != "attribute")
    return journal.inspect(about).where(shown)


def _with_reference(spark, sf, names, *stops, run=True):
    """Grid, reference state and, with ``run``, indices brought up to each day of ``stops`` and then to the end."""
    root, table = scratch_dir(spark), xwalk(spark, sf) if run else None
    source = tables.grid_daily(spark, sf).select("time", *CELL, "tasmax", "tasmin", "pr")
    variables = ["tasmax", "tasmin", "pr"]
    about = ingest.grid_journal(spark, root, variables, _THEN)
    state = reference.Reference(spark, about.path, names)
    for stop in (*stops, _end(source)):
        days = source.where(F.col("time") <= F.lit(stop))
        if store.exists(spark, about.path):
            incremental.update_grid(spark, about.path, days, stop, about)
        else:
            journal.create(about, store.with_year(days))
        grid = spark.read.parquet(about.path)
        if run:
            index_run.run(spark, f"{root}/indices", grid, table, names, now=_NOW, sample=DAILY, days=about.held(), reference=state)
        else:
            state.extend(grid, about.held())
    return root, state


@query("i3_reference_kept", _THREE)
def i3_reference(spark, sf):
    root, _ = _with_reference(spark, sf, _NAMES, dt.date(1999, 3, 31), dt.date(2000, 8, 31))
    return spark.read.parquet(f"{root}/indices").select(
        "region_set", "region", "index", text("time").alias("time"), "time_filter", r6("value").alias("value")
    )


@query(
    "a16_percentile_from_kept_state",
    q.with_(q.GRID, DOY, STRETCH) + "SELECT lat, lon, CAST(doy AS BIGINT) AS doy, round(q, 6) AS q FROM pct",
)
def a16_kept(spark, sf):
    """Percentiles from state that was extended twice equal those of the whole history.

    The state needs no index store and no regions.
    """
    _, state = _with_reference(spark, sf, ("r95ptot",), dt.date(1999, 3, 31), dt.date(2000, 8, 31), run=False)
    rows = state.percentiles("r95ptot").select(*CELL, F.posexplode_outer("qs").alias("position", "q"))
    return rows.where(F.col("q").isNotNull()).select(*CELL, big(F.col("position") + 1).alias("doy"), r6("q").alias("q"))
