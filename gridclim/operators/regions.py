"""From grid cells to regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import CELL
from ..functions import axis, geometry, numeric
from ..session import materialise

REGION = ("region_set", "region")


def unique_names(regions: DataFrame) -> DataFrame:
    """``label``: the name, with the country added where a set repeats it.

    Repeats are counted by a partial aggregate and joined back, so a name shared by
    many regions does not gather them in one task.
    """
    counts = regions.groupBy("region_set", "name").agg(F.count("*").alias("repeats"))
    long = F.concat("name", F.lit(" ("), "country", F.lit(")"))
    return (
        regions.join(counts.where(F.col("repeats") > 1), ["region_set", "name"], "left")
        .withColumn("label", F.when(F.col("repeats").isNotNull(), long).otherwise(F.col("name")))
        .select(*regions.columns, "label")
    )


def cells_of(grid: DataFrame) -> DataFrame:
    return grid.select(*CELL).distinct()


def cells_inside(cells: DataFrame, regions: DataFrame, tile: float = 1.0) -> DataFrame:
    """``region_set, region, lat, lon`` for every cell centre inside a region.

    The map is cut into square tiles, and cells meet regions by equality on the tile. In a tile
    that no edge comes near, all cells lie inside or none does, so they are not tested. The
    others are tested against the edges that meet their row of tiles: an outline is kept once
    in all, cut by rows, whatever number of tiles its box has. A tile holds a bounded number of cells, so there is
    neither a nested loop nor a hot key.
    """
    edges, tiles = outline_edges(regions), outline_tiles(regions, tile)
    rows = row_edges(edges, tile)
    lon, lat = F.col("lon"), F.col("lat")
    placed = cells.select(*CELL, _tile(lon, tile).alias("tx"), _tile(lat, tile).alias("ty"))
    near = placed.join(tiles, ["tx", "ty"])
    whole = near.where("NOT touched").select(*REGION, *CELL)
    tested = near.where("touched").join(rows, [*REGION, "ty"]).where(geometry.inside(F.col("edges"), lon, lat))
    return whole.unionByName(tested.select(*REGION, *CELL))


def outline_edges(regions: DataFrame) -> DataFrame:
    """``region_set, region, x1, y1, x2, y2``: one row per edge."""
    return regions.select(*REGION, F.inline(geometry.edges(F.col("rings"))))


def _span(a: str, b: str, tile: float) -> Column:
    """Tiles that an edge's ends and all between them lie in."""
    return F.explode(F.sequence(_tile(F.least(a, b), tile), _tile(F.greatest(a, b), tile)))


def row_edges(edges: DataFrame, tile: float) -> DataFrame:
    """``region_set, region, ty, edges``: the edges whose span meets a row of tiles."""
    return (
        edges.withColumn("ty", _span("y1", "y2", tile))
        .groupBy(*REGION, "ty")
        .agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    )


def outline_tiles(regions: DataFrame, tile: float) -> DataFrame:
    """``region_set, region, tx, ty, touched``: tiles with an edge near, and tiles wholly inside."""
    edges = outline_edges(regions)
    touched = (
        edges.withColumn("tx", _span("x1", "x2", tile)).withColumn("ty", _span("y1", "y2", tile)).select(*REGION, "tx", "ty").distinct()
    )
    box = geometry.bounds(F.col("rings"))
    every = (
        regions.select(*REGION, box.alias("b"))
        .select(*REGION, F.explode(F.sequence(_tile(F.col("b.x0"), tile), _tile(F.col("b.x1"), tile))).alias("tx"), "b")
        .select(*REGION, "tx", F.explode(F.sequence(_tile(F.col("b.y0"), tile), _tile(F.col("b.y1"), tile))).alias("ty"))
    )
    key = [*REGION, "tx", "ty"]
    centre = [(F.col(c) + 0.5) * tile for c in ("tx", "ty")]
    inner = (
        every.join(touched, key, "left_anti")
        .join(row_edges(edges, tile), [*REGION, "ty"])
        .where(geometry.inside(F.col("edges"), *centre))
        .select(*key)
    )
    return touched.withColumn("touched", F.lit(True)).unionByName(inner.withColumn("touched", F.lit(False)))


def _tile(value, tile: float):
    return F.floor(value / F.lit(tile))


def empty_regions(regions: DataFrame, inside: DataFrame) -> DataFrame:
    """Regions without a cell centre."""
    return regions.join(inside.select(*REGION).distinct(), list(REGION), "left_anti")


def nearest_cells(regions: DataFrame, cells: DataFrame) -> DataFrame:
    """The cell nearest to the centre of each region's box.

    Latitude and longitude are chosen independently on their axes; of two equally
    near labels the larger is taken.
    """
    box = geometry.bounds(F.col("rings"))
    centred = regions.select(*REGION, box.alias("box")).select(
        *REGION,
        ((F.col("box.y0") + F.col("box.y1")) / 2).alias("cy"),
        ((F.col("box.x0") + F.col("box.x1")) / 2).alias("cx"),
        axis.labels(cells, "lat").alias("lats"),
        axis.labels(cells, "lon").alias("lons"),
    )
    return centred.select(
        *REGION,
        numeric.nearest_label(F.col("lats"), F.col("cy")).alias("lat"),
        numeric.nearest_label(F.col("lons"), F.col("cx")).alias("lon"),
    )


def crosswalk(cells: DataFrame, regions: DataFrame, tile: float = 1.0) -> DataFrame:
    """``region_set, region, lat, lon, w, filled``: cells and weights of every region.

    Depends on the grid and the outlines only; build it once per grid, keep it as a
    table (see ``session.materialise``) and reuse it for every variable and day. The
    cells and the hits are written on the way, since several steps read them.
    """
    cells = materialise(cells.select(*CELL))
    inside = materialise(cells_inside(cells, regions, tile))
    weighted = inside.select(
        *REGION, *CELL, numeric.latitude_weight(F.col("lat")).alias("w"), F.lit(False).alias("filled")
    )
    fill = nearest_cells(empty_regions(regions, inside), cells).select(
        *REGION, *CELL, F.lit(1.0).alias("w"), F.lit(True).alias("filled")
    )
    return weighted.unionByName(fill)


def aggregate_regions(
    grid: DataFrame,
    xwalk: DataFrame,
    variables: list[str],
    keys: tuple[str, ...] = ("time",),
    scattered: bool = False,
    tile: float | None = None,
) -> DataFrame:
    """Area-weighted mean per region; one job for all region sets.

    No join hint: the planner broadcasts the crosswalk when its table is small and
    shuffles otherwise. The join sends a cell to each of its regions, so what is
    exchanged matters:

    * Stores are written in time order, so a task holds whole days, and partial sums
      leave about one row per region and day. This is the default.
    * For ``scattered`` rows, as they come out of another exchange, cell rows are
      partitioned by ``keys`` first. The joined rows are then never exchanged. A key
      has at most one row per cell, so none is hot.
    * With a crosswalk beyond the broadcast limit, ``tile`` deals both sides by square map
      tiles of that size, so that neither join nor first sums move a joined row. The planner
      keeps that partitioning where ``spark.sql.requireAllClusterKeysForCoPartition`` is
      false; elsewhere it partitions by cell and moves first sums too, with equal results.
    """
    if tile is not None and tuple(keys) == ("time",) and dict(grid.dtypes)["time"] == "date":
        return _days_by_tiles(grid, xwalk, variables, tile)
    if tile is not None:
        return _by_tiles(grid, xwalk, variables, keys, tile)
    if scattered:
        grid = grid.repartition(*keys)
    joined = grid.join(xwalk.select(*REGION, *CELL, "w"), list(CELL))
    return joined.groupBy(*REGION, *keys).agg(
        *[numeric.weighted_mean(F.col(v), F.col("w")).alias(v) for v in variables]
    )


SLOTS = 32  # days of one variable side by side; many more columns than that would leave generated code


def aggregate_days(
    grid: DataFrame, xwalk: DataFrame, variables: list[str], due: DataFrame | None = None, tile: float = 4.0
) -> DataFrame:
    """Daily area-weighted means per region, ``region_set, region, time, <variables>``, over many days.

    A cell is in dozens of regions, so rows are packed before they meet them: cell rows are dealt
    by map tile and block of days, and a cell and block become one row with a sum and a count per day. That row
    is sent to each region once, and sums are kept per region and block, not per region and day; days
    become rows again at the end. A tile holds most regions whole, so a region
    leaves few rows of sums to exchange. Beside the sums, a bit per day says whether it has any row.

    ``due``, rows of ``region_set, time``, restricts the days of each set; blocks without a day due are not summed.
    """
    slots = max(1, SLOTS // len(variables))
    cells = _packed(grid, variables, slots, tile, ("tx", "ty", "_block"))
    if due is not None:
        # At most as many rows as the calendar has blocks, each with a bit mask per region set.
        masks = due.select("region_set", *_slot_of_day(slots)).groupBy("region_set", "_block").agg(_bits().alias("_due"))
        sets = masks.groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("region_set", "_due"))).alias("_due"))
        cells = cells.join(F.broadcast(sets), "_block")
    joined = cells.join(xwalk.select(*REGION, *CELL, "w"), list(CELL))
    if due is not None:
        wanted = F.col("_days").bitwiseAND(F.try_element_at("_due", F.col("region_set")))
        joined = joined.withColumn("_days", wanted).where(F.col("_days") != 0)
    sums = joined.groupBy(*REGION, "_block").agg(*_summed(len(variables), slots, F.col("w")))
    return _unpacked(sums, variables, slots)


def _bits() -> Column:
    return F.bit_or(F.expr("shiftleft(1L, _slot)"))


def _slot_of_day(slots: int) -> list[Column]:
    day = F.unix_date("time")
    return [F.floor(day / slots).cast("int").alias("_block"), F.coalesce(F.pmod(day, F.lit(slots)), F.lit(0)).alias("_slot")]


def _packed(grid: DataFrame, variables: list[str], slots: int, tile: float, deal: tuple[str, ...]) -> DataFrame:
    """``tx, ty, _block, lat, lon, _days`` and per variable and day of the block its sum and count."""
    values = [F.col(v).alias(f"_v{i}") for i, v in enumerate(variables)]
    place = {"tx": _tile(F.col("lon"), tile), "ty": _tile(F.col("lat"), tile)}
    rows = grid.select(*_slot_of_day(slots), *CELL, *values).withColumns(place).repartition(*deal)
    of_day = [(i, d, F.when(F.col("_slot") == d, F.col(f"_v{i}"))) for i in range(len(variables)) for d in range(slots)]
    sums = [c for i, d, v in of_day for c in (F.sum(v).alias(f"_s{i}_{d}"), F.count(v).alias(f"_n{i}_{d}"))]
    return rows.groupBy("tx", "ty", "_block", *CELL).agg(*sums, _bits().alias("_days"))


def _summed(n: int, slots: int, weight: Column) -> list[Column]:
    names = [f"{c}{i}_{d}" for i in range(n) for d in range(slots) for c in ("_s", "_n")]
    return [*[F.sum(F.col(c) * weight).alias(c) for c in names], F.bit_or("_days").alias("_days")]


def _unpacked(sums: DataFrame, variables: list[str], slots: int) -> DataFrame:
    """Days that have a row, one by one; without a present value the mean is missing."""
    means = F.array(*[
        F.struct(F.lit(d).alias("_slot"), *[F.try_divide(f"_s{i}_{d}", f"_n{i}_{d}").alias(v) for i, v in enumerate(variables)])
        for d in range(slots)
    ])
    time = F.date_from_unix_date(F.col("_block") * slots + F.col("_slot")).alias("time")
    rows = sums.select(*REGION, "_block", "_days", F.inline(means)).where("_days & shiftleft(1L, _slot) != 0")
    return rows.select(*REGION, time, *variables)


def _days_by_tiles(grid: DataFrame, xwalk: DataFrame, variables: list[str], tile: float) -> DataFrame:
    """As :func:`_by_tiles`, with cell rows packed into blocks of days before the join."""
    slots = max(1, SLOTS // len(variables))
    place = {"tx": _tile(F.col("lon"), tile), "ty": _tile(F.col("lat"), tile)}
    cells = _packed(grid, variables, slots, tile, ("tx", "ty"))
    weights = xwalk.select(*REGION, *CELL, "w").withColumns(place).repartition(*place)
    partial = cells.join(weights, [*place, *CELL]).groupBy(*place, *REGION, "_block").agg(*_summed(len(variables), slots, F.col("w")))
    total = partial.groupBy(*REGION, "_block").agg(*_summed(len(variables), slots, F.lit(1.0)))
    return _unpacked(total, variables, slots)


def _by_tiles(grid: DataFrame, xwalk: DataFrame, variables: list[str], keys: tuple[str, ...], tile: float) -> DataFrame:
    """Weighted sums per tile, region and ``keys``, then their sums over tiles.

    Cells and crosswalk share one partitioning by tile. What is exchanged after the join is
    one row of sums per tile, region and key. A tile holds a bounded number of cells, each with
    one row per key, so a tile is no larger than the calendar times its cells.
    """
    place = {"tx": _tile(F.col("lon"), tile), "ty": _tile(F.col("lat"), tile)}
    cells = grid.select(*keys, *CELL, *variables).withColumns(place).repartition(*place)
    weights = xwalk.select(*REGION, *CELL, "w").withColumns(place).repartition(*place)
    sums = [
        s
        for i, v in enumerate(variables)
        for s in (
            F.sum(F.col(v) * F.col("w")).alias(f"_s{i}"),
            F.sum(F.when(F.col(v).isNotNull(), F.col("w"))).alias(f"_w{i}"),
        )
    ]
    partial = cells.join(weights, [*place, *CELL]).groupBy(*place, *REGION, *keys).agg(*sums)
    return partial.groupBy(*REGION, *keys).agg(
        *[F.try_divide(F.sum(f"_s{i}"), F.sum(f"_w{i}")).alias(v) for i, v in enumerate(variables)]
    )
