"""Indices from a stored grid to a stored table, in full or as an update."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import DAILY, STANDARD_FREQS
from ..operators import completeness, indices
from ..session import materialise
from ..sources import journal, store
from ..sources.journal import Journal
from . import derived_index, describe, incremental
from .ingest import now_text
from .reference import Reference


def check_sources(grid: DataFrame, names: tuple[str, ...], sample: str | None = None, days: DataFrame | None = None) -> None:
    """Every index finds its variables, and the time axis is daily; else an error.

    The frequency is inferred, which gaps do not allow, unless ``sample`` states it.
    """
    wanted = {v for n in names for v in indices.get_index(n).index.inputs}
    absent = sorted(wanted - set(grid.columns))
    if absent:
        raise FileNotFoundError(f"no source for {absent}")
    freq = sample or completeness.require_frequency(grid if days is None else days)
    if freq != DAILY:
        raise ValueError(f"indices need daily values, the time axis is {freq}")


def index_journal(spark: SparkSession, path: str, now: str | None = None, sources: tuple[str, ...] = ()) -> Journal:
    about = describe.index(spark, now or now_text(), sources=sources)
    return Journal(spark, path, incremental.index_labels, about)


def run(
    spark: SparkSession,
    path: str,
    grid: DataFrame,
    xwalk: DataFrame,
    names: tuple[str, ...],
    freqs: tuple[str, ...] = STANDARD_FREQS,
    *,
    overwrite: bool = False,
    refresh: bool = False,
    now: str | None = None,
    sources: tuple[str, ...] = (),
    sample: str | None = None,
    days: DataFrame | None = None,
    reference: Reference | None = None,
) -> dict[str, str]:
    """Bring the index store at ``path`` up to the grid; says per index what was done.

    An index is updated where the attributes of all its region sets are stored and name
    every requested frequency; else it is computed in full. All indices that need
    it share one pass over the daily rows. ``sample`` states the frequency of the grid, ``days`` are the days of the grid where they are known, as
    from its journal. ``reference`` is the state beside the grid; it is brought up to them first.
    """
    check_sources(grid, names, sample, days)
    if reference is not None:
        reference.extend(grid, grid.select("time").distinct() if days is None else days)
    about = index_journal(spark, path, now, sources)
    if overwrite or not store.exists(spark, path):
        full = derived_index.regional_indices(grid, xwalk, names, freqs, axis_of=days, reference=reference)
        journal.create(about, store.with_year(full))
        return dict.fromkeys(names, "written")
    sets = xwalk.select("region_set").distinct()
    outputs = sets.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("index"), "region_set")
    outputs = outputs.withColumn("dataset", F.concat_ws("/", "index", "region_set"))
    flags = incremental.updatable(outputs, about.attributes(), freqs)
    ready = {r["index"] for r in flags.where("updatable").collect()}  # an entry per index
    done = {}
    whole = tuple(n for n in names if n not in ready)
    if whole:
        full = materialise(derived_index.regional_indices(grid, xwalk, whole, freqs, axis_of=days, reference=reference))
        store.update_store(spark, path, full, incremental.INDEX_KEY, record=about)
        done |= dict.fromkeys(whole, "written")
    rest = tuple(n for n in names if n in ready)
    if rest:
        changed = incremental.update_index(spark, path, grid, xwalk, rest, freqs, refresh, about, days, reference)
        done |= dict.fromkeys(rest, "updated" if changed else "current")
    return done
