"""What a dataset says about itself: its attributes, the labels it holds, and its commits.

Three small tables lie beside a dataset at ``path`` that is partitioned by ``year``:

* ``<path>-commits``: one row before years are swapped in and one after that, so a run
  that broke in between is told by its open row;
* ``<path>-labels``: the distinct labels of each year, as far as the calendar goes;
* ``<path>-attributes``: ``dataset, attrs`` as of each commit.

A run reads what is due off the labels and never scans the dataset for it. Labels of years that
a broken commit may have touched are read from the dataset again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import axis
from ..session import small_table
from . import metadata, store

# A frame with ``year`` and the labels of a dataset's rows, from the rows.
Labels = Callable[[DataFrame], DataFrame]
# New ``dataset, attrs`` from the stored ones and the labels held.
Describe = Callable[[DataFrame, DataFrame], DataFrame]

COMMITS = "version int, done boolean, years array<int>"
ATTRIBUTES = "version int, dataset string, attrs map<string,string>"


@dataclass(frozen=True)
class Commit:
    """``years`` are the ones swapped in; None stands for the whole dataset."""

    version: int
    done: bool
    years: tuple[int, ...] | None


class Journal:
    """The tables beside one dataset."""

    def __init__(self, spark: SparkSession, path: str, labels: Labels, describe: Describe | None = None) -> None:
        self.spark, self.path, self.labels, self.describe = spark, path, labels, describe

    def _table(self, name: str, schema: str | None = None) -> DataFrame | None:
        path = f"{self.path}-{name}"
        if not store.exists(self.spark, path):
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(path)

    def latest(self) -> Commit | None:
        """The newest commit, done or begun; None where nothing was ever recorded."""
        commits = self._table("commits", COMMITS)
        if commits is None:
            return None
        row = commits.agg(F.max_by(F.struct("version", "done", "years"), F.struct("version", "done")).alias("c")).first()["c"]
        return Commit(row["version"], row["done"], None if row["years"] is None else tuple(row["years"]))

    def attributes(self) -> DataFrame:
        """``dataset, attrs`` as of the last commit that was done."""
        stored, commits = self._table("attributes", ATTRIBUTES), self._table("commits", COMMITS)
        if stored is None or commits is None:
            return small_table(self.spark, [], "dataset string, attrs map<string,string>")
        done = commits.where("done").select(F.max("version").alias("v")).scalar()
        return stored.where(F.col("version") == done).select("dataset", "attrs")

    def held(self) -> DataFrame:
        """The labels that the dataset holds.

        After a broken commit, those of its years come from the dataset; the rest never does.
        """
        commit, stored = self.latest(), self._table("labels")
        dataset = self.spark.read.parquet(self.path)
        if commit is None or stored is None or (not commit.done and commit.years is None):
            return self.labels(dataset)
        if commit.done:
            return stored
        open_years = F.col("year").isin(list(commit.years))
        return stored.where(~open_years).unionByName(self.labels(dataset.where(open_years)))

    def begin(self, years: list[int] | None) -> Commit:
        """Record that years are about to be swapped; those of a broken commit stay open with them."""
        before = self.latest()
        if before is not None and not before.done and years is not None:
            years = None if before.years is None else [*{*years, *before.years}]
        commit = Commit(0 if before is None else before.version + 1, False, None if years is None else tuple(sorted(years)))
        self._record(commit)
        return commit

    def finish(self, commit: Commit) -> None:
        """Note labels and attributes of what was swapped in, then that it is done."""
        dataset = self.spark.read.parquet(self.path)
        options = {"partitionOverwriteMode": "static" if commit.years is None else "dynamic"}
        if commit.years is not None:
            dataset = dataset.where(F.col("year").isin(list(commit.years)))
        labels = self.labels(dataset).repartition("year")
        labels.write.mode("overwrite").options(**options).partitionBy("year").parquet(f"{self.path}-labels")
        if self.describe is not None:
            described = self.describe(self.attributes(), self.spark.read.parquet(f"{self.path}-labels"))
            row = described.select(F.lit(commit.version).alias("version"), "dataset", "attrs")
            row.coalesce(1).write.mode("append").parquet(f"{self.path}-attributes")  # a row per output
        self._record(Commit(commit.version, True, commit.years))

    def _record(self, commit: Commit) -> None:
        years = None if commit.years is None else list(commit.years)
        row = small_table(self.spark, [(commit.version, commit.done, years)], COMMITS)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}-commits")


def create(journal: Journal, df: DataFrame) -> None:
    """Write a dataset anew, with what it says about itself."""
    commit = journal.begin(None)
    store.write_store(df, journal.path, "overwrite", ["year"])
    journal.finish(commit)


COORDINATES = ("time", "lat", "lon", "region_set", "region", "index", "time_filter", "period")


def inspect(journal: Journal) -> DataFrame:
    """``dataset, kind, name, value``: attributes, variables with their types, coordinates with their sizes.

    Attributes and labels come from the tables beside the dataset, columns from its schema;
    only coordinates that are no labels are read, each one by itself.
    """
    df = journal.spark.read.parquet(journal.path)
    held = journal.held()
    kinds = {n: t for n, t in df.dtypes if n != "year"}
    rows = [("*", "variable", n, t) for n, t in kinds.items() if n not in COORDINATES]
    sized = [
        journal.spark.range(1).select(
            F.lit("*").alias("dataset"), F.lit("coordinate").alias("kind"), F.lit(n).alias("name"),
            axis.scalar((held if n in held.columns else df).select(n).distinct(), F.count(n)).cast("string").alias("value"),
        )
        for n in kinds if n in COORDINATES
    ]
    attributes = metadata.as_rows(journal.attributes()).select("dataset", F.lit("attribute").alias("kind"), F.col("key").alias("name"), "value")
    parts = [attributes, small_table(journal.spark, rows, "dataset string, kind string, name string, value string"), *sized]
    return reduce(DataFrame.unionByName, parts)
