"""Datasets as partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import CELL
from ..functions import axis, numeric, ordered
from ..model import require_columns
from ..session import materialise

GRID_KEY = ("time", *CELL)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds a dataset whose write was committed.

    A job that fails leaves files behind but no ``_SUCCESS``.
    """
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    fs = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(marker)


def read_store(
    spark: SparkSession,
    path: str,
    variables: str | Sequence[str] | None = None,
    steps: tuple[int, int] | None = None,
    box: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Open a store with a projection and slices.

    ``steps`` selects positions ``[a, b)`` of the time axis; ``box`` selects labels,
    both ends included. Projection and label slices reach the Parquet scan. NaN is
    missing.
    """
    df = clean(spark.read.parquet(path))
    if variables is not None:
        names = [variables] if isinstance(variables, str) else list(variables)
        unknown = [n for n in names if n not in df.columns]
        if unknown:
            raise ValueError(f"variables {unknown} are not in the store; it has {df.columns}")
        coordinates = [c for c in ("time", "lat", "lon", "region_set", "region") if c in df.columns]
        df = df.select(*coordinates, *names)
    for name, (low, high) in (box or {}).items():
        df = df.where(F.col(name).between(low, high))
    return df if steps is None else step_slice(df, spark.read.parquet(path), *steps)


def step_slice(df: DataFrame, whole: DataFrame, first: int, stop: int) -> DataFrame:
    """Rows whose time label has a position in ``[first, stop)`` on the whole axis.

    The selected labels are contiguous, so two dates are enough to filter with.
    """
    chosen = axis.time_positions(whole).where(
        (F.col("position") >= first) & (F.col("position") < stop)
    )
    low = chosen.select(F.min("time").alias("t")).scalar()
    high = chosen.select(F.max("time").alias("t")).scalar()
    return df.where(F.col("time").between(low, high))


def clean(df: DataFrame, variables: Sequence[str] | None = None) -> DataFrame:
    """NaN to NULL, in all floating columns but the coordinates unless some are named."""
    if variables is None:
        variables = [n for n, t in df.dtypes if t in ("double", "float") and n not in CELL]
    require_columns(df, list(variables))
    return df.withColumns({v: numeric.missing_to_null(F.col(v)) for v in variables})


def combine_by_coords(frames: Sequence[DataFrame]) -> DataFrame:
    """Many files as one dataset: pieces of one variable are stacked, different
    variables are merged on their coordinates."""
    groups: dict[tuple[str, ...], list[DataFrame]] = {}
    for df in frames:
        groups.setdefault(tuple(sorted(df.columns)), []).append(df)
    return merge_variables([reduce(DataFrame.unionByName, g) for g in groups.values()])


def merge_variables(frames: Sequence[DataFrame], key: Sequence[str] = GRID_KEY) -> DataFrame:
    """Outer merge on shared coordinates; absent values are missing."""
    return reduce(lambda a, b: a.join(b, list(key), "full"), frames)


def write_store(
    df: DataFrame,
    path: str,
    mode: str = "skip",
    partition_by: Sequence[str] = (),
) -> bool:
    """Write a dataset. ``skip`` leaves an existing one alone, ``overwrite`` replaces
    it, ``append`` adds. Returns whether anything was written; failures raise.

    What a failed write left at the path does not count as a dataset and is replaced.
    """
    spark = df.sparkSession
    if mode == "skip":
        if exists(spark, path):
            return False
        mode = "overwrite"
    _write(df, path, mode, partition_by)
    return True


def _write(df: DataFrame, path: str, mode: str, partition_by: Sequence[str], **options: str) -> None:
    """Partitioned writes are rebalanced first: one file per partition value where it is
    small, several where it is large, ordered by time and place inside."""
    if partition_by:
        order = [c for c in GRID_KEY if c in df.columns]
        df = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *order)
    writer = df.write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def with_year(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("time"))


def upserted(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Old rows whose key is not in ``new``, and all of ``new``."""
    return old.join(new.select(*key), list(key), "left_anti").unionByName(
        new, allowMissingColumns=True
    )


def align_labels(new: DataFrame, labels: DataFrame, dim: str) -> DataFrame:
    """Rows of stored labels: unknown labels are dropped, absent ones are missing.

    A short list of labels is broadcast by the planner, so ``new`` is not shuffled.
    """
    known = labels.select(dim).distinct()
    kept = new.join(known, dim, "left_semi")
    absent = known.join(new.select(dim).distinct(), dim, "left_anti")
    return kept.unionByName(absent, allowMissingColumns=True)


class Record(Protocol):
    """Who wants to know which years an update swaps in."""

    def begin(self, years: list[int] | None) -> Any: ...

    def finish(self, commit: Any) -> None: ...


def update_store(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    key: Sequence[str],
    label_dim: str | None = None,
    record: Record | None = None,
) -> bool:
    """Upsert into a store partitioned by ``year``; rows in ``new`` win.

    Only the years that ``new`` touches are read and rewritten, and each of those is
    swapped as a whole when the job commits, so a rerun gives the same store.
    ``label_dim`` drops incoming rows whose label the store does not know. ``record`` is
    told before the swap and after it. Returns whether there was anything to write.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"store {path} does not exist")
    old = spark.read.parquet(path)
    if label_dim is not None:
        new = new.join(old.select(label_dim).distinct(), label_dim, "left_semi")
    # Read three times below, so computed once.
    new = materialise(new if "year" in new.columns else with_year(new))
    years = [r["year"] for r in new.select("year").distinct().collect()]  # bounded by the calendar
    if not years:
        return False
    affected = old.where(F.col("year").isin(years))
    commit = None if record is None else record.begin(years)
    _write(
        upserted(affected, new, key).select(*old.columns),
        path,
        "overwrite",
        ["year"],
        partitionOverwriteMode="dynamic",
    )
    if record is not None:
        record.finish(commit)
    return True


def compact_types(df: DataFrame, keep: Sequence[str] = (*CELL,)) -> DataFrame:
    """Doubles to FLOAT, coordinates excepted. Only for sinks."""
    return df.withColumns(
        {n: F.col(n).cast("float") for n, t in df.dtypes if t == "double" and n not in keep}
    )


def write_compact(df: DataFrame, path: str, mode: str = "skip") -> bool:
    return write_store(compact_types(df), path, mode)


def compact_files(
    spark: SparkSession, paths: Sequence[str], out: str, partitions: int | None = None
) -> DataFrame:
    """Many small files as one store, ordered by place so that box reads skip files."""
    df = spark.read.parquet(*paths)
    ranged = (
        df.repartitionByRange(*CELL)
        if partitions is None
        else df.repartitionByRange(partitions, *CELL)
    )
    ranged.sortWithinPartitions(*CELL, "time").write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


# Tile sizes of the physical layout.
REGION_TILE_LIMIT, REGION_TILE = 400, 50
GRID_TILE = {"time": 1000, "lat": 100, "lon": 100}


def layout(dims: Sequence[str], n_regions: int = 0, region_tile: int | None = None) -> dict[str, int]:
    """Tile size per dimension; -1 is the whole dimension.

    ``region_tile`` is the size a dataset was first written with, to be kept in its
    attributes; the number of regions decides only when there is none yet.
    """
    sizes: dict[str, int] = {}
    if "region" in dims:
        first = 1 if n_regions <= REGION_TILE_LIMIT else REGION_TILE
        sizes["region"] = first if region_tile is None else region_tile
    for dim in ("combined", "time"):
        if dim in dims:
            sizes[dim] = -1
    if "time_filter" in dims:
        sizes["time_filter"] = 1
    if "lat" in dims and "lon" in dims:
        sizes.update(GRID_TILE)
    return sizes


def with_tiles(df: DataFrame) -> DataFrame:
    """``tile_lat, tile_lon``: block numbers of the grid layout, to range-partition by."""
    return df.withColumns(
        {
            f"tile_{d}": F.floor(
                axis.position_of(axis.labels(df, d), F.col(d)) / GRID_TILE[d]
            )
            for d in CELL
        }
    )


def with_region_tiles(df: DataFrame, region_tile: int | None = None) -> DataFrame:
    """``tile_region``: block of a region in its set, by rank of its id.

    ``region_tile`` as for :func:`layout`: with it, old rows keep their block when
    the number of regions grows.
    """
    regions = ordered.rank_within(
        df.select("region_set", "region").distinct(), "region_set", "region", "rank"
    )
    size = F.when(F.col("rank_of") <= REGION_TILE_LIMIT, 1).otherwise(REGION_TILE)
    size = size if region_tile is None else F.lit(region_tile)
    tiles = regions.select("region_set", "region", F.floor(F.col("rank") / size).alias("tile_region"))
    return df.join(tiles, ["region_set", "region"])
