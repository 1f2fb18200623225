"""Updates that only compute what is new and give what a full run gives."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import axis, calendar
from ..model import STANDARD_FREQS
from ..operators import canon, completeness, regions
from ..operators.percentiles import WINDOW
from ..session import materialise
from ..sources import metadata, store
from ..sources.journal import Journal
from . import derived_index
from .reference import Reference, months_around

GRID_KEY = ("time", "lat", "lon")
REGIONAL_KEY = ("region_set", "region", "time")
INDEX_KEY = ("region_set", "region", "index", "time", "time_filter")


def index_labels(stored: DataFrame) -> DataFrame:
    freq = calendar.freq_of_filter(F.col("time_filter")).alias("freq")
    return stored.select("year", "region_set", "index", freq, "period", "time").distinct()


def default_end(today: dt.date | None = None) -> dt.date:
    """Last day of the previous month; the clock can be given."""
    today = today or dt.date.today()
    return today.replace(day=1) - dt.timedelta(days=1)


def update_grid(
    spark: SparkSession, path: str, source: DataFrame, end: dt.date, journal: Journal | None = None
) -> bool:
    """Append the days up to ``end`` that the store lacks. False when there are none.

    With a journal the days come from the labels it noted, and attributes are refreshed; a commit
    that broke is among its commits, and only its years are read again. Without one, the time column of the
    years that the source covers is read. Years are swapped one by one when an update
    commits; what a broken commit left out is among the lacking days.
    """
    days = canon.between_dates(source, None, end.isoformat())
    if journal is None:
        years = F.col("year").between(*(axis.scalar(days, f(F.year("time"))) for f in (F.min, F.max)))
        held = axis.time_axis(spark.read.parquet(path).where(years))
    else:
        held = journal.held().select("time")
    absent = axis.time_axis(days).join(held, "time", "left_anti")
    due = days.join(absent, "time", "left_semi")
    return store.update_store(spark, path, store.clean(due), GRID_KEY, record=journal)


def region_increment(
    grid: DataFrame, xwalk: DataFrame, stored: DataFrame, end: dt.date
) -> tuple[DataFrame, DataFrame]:
    """The rows of days that any region set still lacks, and ``region_set, time`` of what each lacks.

    ``stored`` gives ``region_set, time``: the regional store, or the labels noted beside it. Each set has its own days: one that lags behind, was
    never written, or lost a year to a broken commit is due where it lacks something.
    """
    days = canon.between_dates(grid, None, end.isoformat())
    sets = xwalk.select("region_set").distinct().agg(F.collect_set("region_set").alias("s"))  # a handful
    wanted = axis.time_axis(days).select("time", F.explode(axis.scalar(sets, F.first("s"))).alias("region_set"))
    # Read three times below, and as long as the calendar.
    lacking = materialise(wanted.join(stored.select("region_set", "time").distinct(), ["region_set", "time"], "left_anti"))
    if "year" in grid.columns:  # years without a due day are not read
        days = days.where(F.col("year") >= F.year(axis.scalar(lacking, F.min("time"))))
    return days.join(lacking.select("time").distinct(), "time", "left_semi"), lacking


def update_regions(
    spark: SparkSession,
    path: str,
    grid: DataFrame,
    xwalk: DataFrame,
    variables: list[str],
    end: dt.date,
    journal: Journal | None = None,
) -> bool:
    """Bring every region set of a regional store up to ``end``; ``journal`` as for a grid."""
    stored = spark.read.parquet(path) if journal is None else journal.held()
    rows, due = region_increment(grid, xwalk, stored, end)
    new = regions.aggregate_days(rows, xwalk, variables, due)
    return store.update_store(spark, path, new, REGIONAL_KEY, record=journal)


def due_from(periods: DataFrame, checkpoints: DataFrame, refresh: bool = False) -> DataFrame:
    """``freq, due``: first complete period strictly after the checkpoint.

    ``periods`` is ``freq, time``, ``checkpoints`` ``freq, last_period``. A frequency
    without a checkpoint is due from its first period; one with nothing new is absent.
    With ``refresh`` the period of the checkpoint is due as well.
    """
    after = F.col("time") > F.col("last_period")
    if refresh:
        after = F.col("time") >= F.col("last_period")
    return (
        periods.join(F.broadcast(checkpoints), "freq", "left")  # one row per frequency
        .where(F.col("last_period").isNull() | after)
        .groupBy("freq")
        .agg(F.min("time").alias("due"))
    )


def update_index(
    spark: SparkSession,
    path: str,
    grid: DataFrame,
    xwalk: DataFrame,
    names: tuple[str, ...],
    freqs: tuple[str, ...] = STANDARD_FREQS,
    refresh: bool = False,
    journal: Journal | None = None,
    days: DataFrame | None = None,
    reference: Reference | None = None,
) -> bool:
    """Compute the periods that the store lacks and upsert them. False when there are none.

    Every region set and index has its own periods, so a new index, a set that lags behind
    and a year that a broken commit left out are all caught up; a store that has none of an
    index gets its whole history. Percentiles, completeness and whether a cell has values
    refer to the whole grid. A period counts as complete with four fifths of its days, so
    the last stored one may have been computed before its last days came; ``refresh``
    computes it again, and then the result equals a full run wherever the last update stopped.

    With ``days``, the days of the grid as its journal noted them, completeness is judged without
    reading the grid, and with ``reference``, brought up to the same days, no day of years that are not due is read.
    """
    days = grid if days is None else days
    stored = index_labels(spark.read.parquet(path)) if journal is None else journal.held()
    due = materialise(due_periods(stored, days, xwalk, names, freqs, refresh))
    starts = {r["freq"]: r["t"] for r in due.groupBy("freq").agg(F.min("period").alias("t")).collect()}
    if not starts:
        return False
    late = {r["index"] for r in due.select("index").distinct().collect()}
    recent = since(grid, min(starts.values()))
    wanted = tuple(n for n in names if n in late)
    if reference is None:
        new = derived_index.regional_indices(recent, xwalk, wanted, tuple(starts), history=grid, axis_of=days, due=starts)
    else:
        # One day more than a window reaches: stretched percentiles look at the day before.
        months = reference_months(canon.between_dates(days, min(starts.values()).isoformat(), None))
        new = derived_index.regional_indices(
            recent, xwalk, wanted, tuple(starts), axis_of=days, due=starts, reference=reference, months=months
        )
    freq = calendar.freq_of_filter(F.col("time_filter"))
    kept = new.withColumn("freq", freq).join(due, ["region_set", "index", "freq", "period"], "left_semi").drop("freq")
    return store.update_store(spark, path, kept, INDEX_KEY, record=journal)


def reference_months(days: DataFrame) -> set[int]:
    return months_around(days, WINDOW + 2)


def since(grid: DataFrame, first: dt.date) -> DataFrame:
    """Rows from a day on; of a grid in years, only those years are read."""
    recent = canon.between_dates(grid, first.isoformat(), None)
    return recent.where(F.col("year") >= first.year) if "year" in grid.columns else recent


def due_periods(
    stored: DataFrame,
    days: DataFrame,
    xwalk: DataFrame,
    names: tuple[str, ...],
    freqs: tuple[str, ...] = STANDARD_FREQS,
    refresh: bool = False,
) -> DataFrame:
    """``region_set, index, freq, period``: complete periods that an index store lacks.

    ``stored`` gives the same four columns: the labels of the store. As many rows at most as region sets times indices times periods of the calendar.
    """
    periods = completeness.complete_periods(days, freqs).select("freq", F.col("time").alias("period"))
    sets = axis.scalar(xwalk.select("region_set").distinct(), F.collect_set("region_set"))  # a handful
    wanted = periods.withColumn("region_set", F.explode(sets)).withColumn(
        "index", F.explode(F.array(*[F.lit(n) for n in names]))
    )
    key = ["region_set", "index", "freq", "period"]
    held = stored.select(*key).distinct()
    if refresh:
        last = held.groupBy("region_set", "index", "freq").agg(F.max("period").alias("period"))
        held = held.join(last, key, "left_anti")
    return wanted.join(held, key, "left_anti").select(*key)


def updatable(outputs: DataFrame, meta: DataFrame, freqs: tuple[str, ...]) -> DataFrame:
    """``index, updatable``: whether every region set's output exists and holds all
    requested frequencies. ``outputs`` is ``index, region_set, dataset``."""
    used = F.transform(F.split(F.coalesce(F.col("attrs")["frequencies_used"], F.lit("")), ","), lambda f: F.trim(f))
    holds = F.lit(True)
    for f in freqs:
        holds = holds & F.array_contains(used, f)
    return (
        outputs.join(meta, "dataset", "left")
        .groupBy("index")
        .agg(F.bool_and(F.coalesce(F.col("attrs").isNotNull() & holds, F.lit(False))).alias("updatable"))
    )


def merge_attributes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Attributes after an index update: descriptive and checkpoint keys are refreshed,
    the creation date and the first valid day stay.

    A map costs far more to merge than to move, so rows are dealt by dataset first, however
    few files they come from.
    """
    pairs = old.select("dataset", F.col("attrs").alias("o")).repartition("dataset").join(
        new.select("dataset", F.col("attrs").alias("n")), "dataset"
    )
    o, n = F.col("o"), F.col("n")
    first = F.split_part(o["dcterms:valid"], F.lit("/"), F.lit(1))
    last = F.split_part(n["dcterms:valid"], F.lit("/"), F.lit(2))
    kept = F.map_filter(
        F.create_map(
            F.lit("dcterms:created"),
            o["dcterms:created"],
            F.lit("dcterms:valid"),
            F.concat(first, F.lit("/"), last),
            F.lit("dcterms:temporal"),
            F.concat(F.lit("start="), first, F.lit("; end="), last),
        ),
        lambda _, v: v.isNotNull(),
    )
    incoming = metadata.merged(n, kept)
    return pairs.select(
        "dataset", metadata.merge_on_update(o, incoming, prefixes=["last_checkpoint_", "dc"]).alias("attrs")
    )
