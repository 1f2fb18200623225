"""From raw files to gridded and regional stores."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..operators import canon, regions, units
from ..sources import journal, store
from ..sources.journal import Journal
from . import describe, incremental


def homogenise(
    raw: DataFrame, variable: str, unit: str, area: tuple[float, float, float, float] | None = None
) -> DataFrame:
    """Canonical names, coordinates and units of one variable."""
    df = units.apply_transform(raw, variable)
    df = canon.canonicalise(df, variable)
    df = store.clean(df, [variable])
    df, _ = units.convert_columns(df, {variable: unit})
    return canon.crop(df, area)


def now_text() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def grid_journal(spark: SparkSession, root: str, variables: list[str], now: str | None = None, cells: DataFrame | None = None) -> Journal:
    about = describe.grid(spark, variables, now or now_text(), cells=cells)
    return Journal(spark, f"{root}/grid", describe.grid_labels, about)


def regional_journal(spark: SparkSession, root: str, variables: list[str], now: str | None = None) -> Journal:
    about = describe.regional(spark, variables, now or now_text(), sources=[f"{root}/grid"])
    return Journal(spark, f"{root}/regional", describe.regional_labels, about)


def ingest(
    spark: SparkSession,
    grid: DataFrame,
    outlines: DataFrame,
    root: str,
    variables: list[str],
    end: dt.date,
    overwrite: bool = False,
    now: str | None = None,
) -> dict[str, bool]:
    """Write or update ``<root>/grid`` and ``<root>/regional``; says what changed.

    Both keep a journal, so a later run knows what they hold and what broke. The clock can
    be given. The crosswalk is built once, as ``<root>/crosswalk``, and reused by later runs; new
    outlines need ``overwrite``.
    """
    now = now or now_text()
    grid_path, regional_path = f"{root}/grid", f"{root}/regional"
    days = store.clean(canon.between_dates(grid.select("time", "lat", "lon", *variables), None, end.isoformat()), variables)
    gridded = grid_journal(spark, root, variables, now, cells=days)
    if overwrite or not store.exists(spark, grid_path):
        journal.create(gridded, store.with_year(days))
        written = True
    else:
        written = incremental.update_grid(spark, grid_path, days, end, gridded)
    whole = spark.read.parquet(grid_path)
    xwalk_path = f"{root}/crosswalk"
    if overwrite or not store.exists(spark, xwalk_path):
        store.write_store(regions.crosswalk(regions.cells_of(whole), outlines), xwalk_path, "overwrite")
    xwalk = spark.read.parquet(xwalk_path)
    areas = regional_journal(spark, root, variables, now)
    if overwrite or not store.exists(spark, regional_path):
        journal.create(areas, store.with_year(regions.aggregate_days(whole, xwalk, variables)))
        regional = True
    else:
        regional = incremental.update_regions(spark, regional_path, whole, xwalk, variables, end, areas)
    return {"grid": written, "regional": regional}
