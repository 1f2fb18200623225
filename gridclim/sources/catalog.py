"""What exists: listings, required stores, parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators.indices import get_index
from ..session import small_table
from . import naming


def list_paths(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``path`` of the files below a root; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path")
    )


def entry_below(spark: SparkSession, root: str, path: Column) -> Column:
    """The first name of a path below ``root``: a file there, or the folder that holds it.

    Paths may differ in how they write scheme and authority.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    depth = fs.makeQualified(folder).toUri().getPath().rstrip("/").count("/")
    bare = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.split_part(bare, F.lit("/"), F.lit(depth + 2))


def list_entries(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``path``: names directly below a root that are, or hold, files of the pattern.

    A dataset is one entry, be it one file or a folder of part files.
    """
    return list_paths(spark, root, pattern).select(entry_below(spark, root, F.col("path")).alias("path")).distinct()


def rows_of_entries(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """``path, n``: rows of the Parquet files of each entry; entries without rows are absent."""
    rows = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).parquet(root)
    # This column is written as a URL, where a plus sign stands for itself.
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return rows.groupBy(file.alias("file")).agg(F.count("*").alias("n")).groupBy(
        entry_below(spark, root, F.col("file")).alias("path")
    ).agg(F.sum("n").alias("n"))


def select_paths(paths: DataFrame, suffix: str | None = None, pattern: str | None = None) -> DataFrame:
    """Filter a listing by suffix and by a shell pattern on the base name."""
    if suffix:
        paths = paths.where(F.col("path").endswith(suffix))
    if pattern:
        paths = paths.where(text.basename(F.col("path")).rlike(text.glob_to_regex(pattern)))
    return paths


def existing(wanted: DataFrame, listing: DataFrame, key: str = "name") -> DataFrame:
    """``wanted`` with ``present``."""
    found = listing.select(key).distinct().withColumn("present", F.lit(True))
    return wanted.join(found, key, "left").withColumn(
        "present", F.coalesce(F.col("present"), F.lit(False))
    )


def store_kind(files: DataFrame) -> DataFrame:
    """``store, kind``: whether a store's listing ``(store, file)`` shows one metadata
    file for all arrays, one per group, or none."""
    has = lambda name: F.bool_or(F.col("file") == name)
    return files.groupBy("store").agg(
        F.when(has(".zmetadata"), "consolidated")
        .when(has(".zgroup") | has("zarr.json"), "unconsolidated")
        .otherwise("none")
        .alias("kind")
    )


def required_stores(spark: SparkSession, index_names: list[str], level: str = "None") -> DataFrame:
    """``index, variable, name``: the grid stores that indices read."""
    rows = [(n, v) for n in index_names for v in get_index(n).index.inputs]
    needed = small_table(spark, rows, "index string, variable string")
    return needed.withColumn("name", naming.grid_store(F.col("variable"), F.lit(level)))


def missing_stores(required: DataFrame, listing: DataFrame) -> DataFrame:
    """Required stores that the listing lacks."""
    return required.join(listing.select("name").distinct(), "name", "left_anti")


def missing_names(required: DataFrame, listing: DataFrame) -> DataFrame:
    """Required names minus existing names, as sets."""
    return required.select("name").subtract(listing.select("name"))


def require_stores(required: DataFrame, listing: DataFrame) -> DataFrame:
    """The required stores; any that is missing is an error."""
    absent = [r["name"] for r in missing_names(required, listing).orderBy("name").collect()]  # one per required store
    if absent:
        raise FileNotFoundError(f"{len(absent)} missing stores: {absent}")
    return required


def parameter_information(variables: DataFrame, params: DataFrame, units: DataFrame) -> DataFrame:
    """Names, unit and description of ``param_id`` through two reference tables.

    A dataset with a variable that has no parameter id has no result, as has an id
    the table lacks.
    """
    complete = variables.groupBy("dataset").agg(
        F.bool_and(F.col("param_id").isNotNull()).alias("complete")
    )
    known = variables.join(complete.where("complete").select("dataset"), "dataset", "left_semi")
    return (
        known.join(params.withColumnRenamed("id", "param_id"), "param_id")
        .join(units.select(F.col("id").alias("unit_id"), F.col("name").alias("units")), "unit_id")
        .select(
            "dataset",
            "variable",
            "param_id",
            F.col("name").alias("long_name"),
            F.col("shortname").alias("short_name"),
            "units",
            "description",
        )
    )
