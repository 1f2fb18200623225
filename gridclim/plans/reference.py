"""What indices need to know of the whole history, kept beside a grid and extended with it.

Two things refer to all days of a grid: whether a cell ever had values, and the values around
each day of year that a percentile is taken over. Both are kept as parts, one per extension:

* ``<grid>-reference/presence``: ``cell`` and a flag per variable;
* ``<grid>-reference/<index>``: ``cell, lat, lon, doy, own, single``, in folders by month of the year.

A part counts once ``<grid>-reference/parts`` names it, so one that broke is never read; its
folder is left over and its version not used again. An extension reads the new days and as many before them as a
window is long. If days came in between the ones already there, everything is read again as a new base.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import CELL
from ..functions import axis
from ..model import PercentileSpec
from ..operators import indices, percentiles
from ..session import small_table
from ..sources import store

PARTS = "version int, base int, first date, last date, days long, longest map<string,int>"


@dataclass(frozen=True)
class Part:
    """Version of a part, of the base it extends, and the time axis up to it.

    ``longest`` is the last day of year on the part of the axis that an index refers to.
    """

    version: int
    base: int
    first: dt.date
    last: dt.date
    days: int
    longest: dict[str, int]


class Reference:
    """Reference state of the indices ``names`` beside the grid at ``path``."""

    def __init__(self, spark: SparkSession, path: str, names: Sequence[str]) -> None:
        self.spark, self.root = spark, f"{path}-reference"
        found = [indices.get_index(n).index for n in names]
        self.variables = sorted({v for i in found for v in i.inputs})
        self.specs: dict[str, tuple[str, PercentileSpec]] = {
            i.name: (i.variable, i.percentile) for i in found if i.percentile is not None and i.percentile.kind == "doy"
        }

    def latest(self) -> Part | None:
        if not store.exists(self.spark, f"{self.root}/parts"):
            return None
        row = self.spark.read.schema(PARTS).parquet(f"{self.root}/parts").agg(F.max_by(F.struct("*"), "version").alias("p")).first()["p"]
        return Part(**row.asDict())

    def extend(self, grid: DataFrame, days: DataFrame) -> str:
        """Bring the state up to ``days``, the days of the grid: ``current``, ``extended`` or ``base``."""
        before = self.latest()
        spans = {name: days.where(spec.span.contains(F.col("time"))) for name, (_, spec) in self.specs.items()}
        a, b, n = days.agg(F.min("time"), F.max("time"), F.count_distinct("time")).first()
        if not n:
            return "current"
        known = 0 if before is None else days.where(F.col("time") <= before.last).select("time").distinct().count()
        follows = before is not None and before.first == a and before.days == known
        if follows and before.last == b:
            return "current"
        version = 0 if before is None else before.version + 1
        longest = {name: some.agg(F.max(F.dayofyear("time"))).first()[0] or 0 for name, some in spans.items()}
        part = Part(version, before.base if follows else version, a, b, n, longest)
        since = before.last if follows else None
        self._write_presence(grid, part, since)
        for name, (variable, spec) in self.specs.items():
            self._write_days(grid, part, since, name, variable, spec, spans[name])
        row = small_table(self.spark, [(part.version, part.base, a, b, n, list(longest.items()))], PARTS)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/parts")
        return "extended" if follows else "base"

    def _new(self, grid: DataFrame, since: dt.date | None, back: int = 0) -> DataFrame:
        if since is None:
            return grid
        first = since - dt.timedelta(days=back)
        rows = grid.where(F.col("time") > F.lit(first))
        return rows.where(F.col("year") >= first.year) if "year" in grid.columns else rows

    def _write_presence(self, grid: DataFrame, part: Part, since: dt.date | None) -> None:
        cell = axis.cell_id(F.col("lat"), F.col("lon")).alias("cell")
        flags = self._new(grid, since).groupBy(cell).agg(*[(F.count(v) > 0).alias(f"has_{v}") for v in self.variables])
        flags.write.mode("overwrite").parquet(f"{self.root}/presence/version={part.version}")

    def _write_days(self, grid: DataFrame, part: Part, since: dt.date | None, name: str, variable: str, spec: PercentileSpec, days: DataFrame) -> None:
        before, after = percentiles.sides(spec.window)
        inside = grid.where(spec.span.contains(F.col("time")))
        rows = percentiles.masked(self._new(inside, since, before), variable, spec)
        low, high = F.date_add("time", -after), F.date_add("time", before)
        if since is not None:  # what older values serve beyond the end of before
            low = F.when(F.col("time") > F.lit(since), low).otherwise(F.greatest(low, F.date_add(F.lit(since), 1)))
        served = F.greatest(low, axis.scalar(days, F.min("time"))), F.least(high, axis.scalar(days, F.max("time")))
        values = percentiles.day_values(rows, variable, served, spec.window)
        month = F.month(F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("doy") - 1))
        parts = values.withColumn("month", month).repartition("month", "cell").sortWithinPartitions("month", "cell")
        parts.write.mode("overwrite").partitionBy("month").parquet(f"{self.root}/{name}/version={part.version}")

    def _parts(self, name: str) -> DataFrame:
        """The rows of all parts since the last base."""
        last = self.latest()
        if last is None:
            raise FileNotFoundError(f"{self.root} holds no reference state")
        kept = self.spark.read.schema(PARTS).parquet(f"{self.root}/parts").where(F.col("base") == last.base)
        versions = [r["version"] for r in kept.select("version").collect()]  # one per extension since a base
        paths = [f"{self.root}/{name}/version={v}" for v in versions]
        return self.spark.read.option("basePath", f"{self.root}/{name}").parquet(*paths)

    def presence(self) -> DataFrame:
        """``cell, has_<variable> …``: cells that ever had values."""
        flags = [F.bool_or(f"has_{v}").alias(f"has_{v}") for v in self.variables]
        return self._parts("presence").groupBy("cell").agg(*flags)

    def percentiles(self, name: str, months: set[int] | None = None) -> DataFrame:
        """``cell, lat, lon, qs`` of an index; with ``months``, of the days of those months only."""
        variable, spec = self.specs[name]
        parts = self._parts(name)
        if months is not None:
            parts = parts.where(F.col("month").isin(sorted(months)))
        together = parts.groupBy("cell", "doy").agg(
            F.first("lat").alias("lat"), F.first("lon").alias("lon"),
            F.flatten(F.collect_list("own")).alias("own"), F.flatten(F.collect_list("single")).alias("single"),
        )
        return percentiles.table_of(percentiles.windows_of(together, spec.window), spec.value, F.lit(self.latest().longest[name]))


def months_around(days: DataFrame, slack: int) -> set[int]:
    """Months of the year within ``slack`` days of any of ``days``: twelve at most."""
    near = F.explode(F.sequence(F.date_add("time", -slack), F.date_add("time", slack)))
    return {r["m"] for r in days.select(near.alias("d")).select(F.month("d").alias("m")).distinct().collect()}
