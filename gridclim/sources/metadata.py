"""Dataset attributes as a table ``dataset, attrs MAP<STRING,STRING>``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Attributes every update refreshes, and ones it removes.
ALWAYS_UPDATED = ("dcterms:temporal", "dcterms:valid", "dc:coverage", "dcterms:modified")
LEGACY = ("start_date", "end_date", "original_frequency", "last_updated")


@dataclass(frozen=True)
class Publisher:
    """Who publishes, as set by the installation."""

    creator: str = "unknown"
    contributor: str = "unknown"
    publisher: str = "unknown"
    prefix: str = ""


def merged(*maps: Column) -> Column:
    """Maps merged key by key; the last one that has a key wins.

    Both maps are put in a struct that a lambda takes, so each is worked out once per row
    and not again for every key of the other.
    """
    return reduce(_overlaid, maps)


def _overlaid(below: Column, above: Column) -> Column:
    def put(pair: Column) -> Column:
        rest = F.map_filter(pair["below"], lambda k, _: ~F.map_contains_key(pair["above"], k))
        return F.map_concat(rest, pair["above"])

    return F.transform(F.array(F.struct(below.alias("below"), above.alias("above"))), put)[0]


def only(attrs: Column, keys: Sequence[str], prefixes: Sequence[str] = ()) -> Column:
    def wanted(k: Column, _) -> Column:
        cond = k.isin(list(keys))
        for p in prefixes:
            cond = cond | k.startswith(p)
        return cond

    return F.map_filter(attrs, wanted)


def without(attrs: Column, keys: Sequence[str]) -> Column:
    return F.map_filter(attrs, lambda k, _: ~k.isin(list(keys)))


def empty() -> Column:
    return F.create_map().cast("map<string,string>")


def drop_all(meta: DataFrame) -> DataFrame:
    return meta.withColumn("attrs", empty())


def drop_grib(meta: DataFrame) -> DataFrame:
    return meta.withColumn("attrs", F.map_filter("attrs", lambda k, _: ~k.startswith("GRIB_")))


def functional(attrs: Column) -> Column:
    """What incremental runs rely on."""
    return only(attrs, ["frequencies_used"], ["last_checkpoint_"])


def merge_on_update(old: Column, new: Column, keys: Sequence[str] = (), prefixes: Sequence[str] = ()) -> Column:
    """Stored attributes after an update: listed and always-updated keys come from the
    incoming ones, legacy keys go."""
    return without(merged(old, only(new, [*keys, *ALWAYS_UPDATED], prefixes)), LEGACY)


def descriptive(now: str, publisher: Publisher = Publisher()) -> Column:
    """The Dublin Core map of a row with columns ``variable, start_date, end_date,
    region_set, area, long_name, description, frequency`` (NULL where unset).

    ``area`` is an array north, west, south, east. The clock is an argument, so a
    rerun gives the same map.
    """
    variable = F.col("variable")
    long_name = F.coalesce(F.col("long_name"), variable)
    frequency = F.coalesce(F.col("frequency"), F.lit("daily"))
    many = F.contains(frequency, F.lit(","))
    label = F.when(many, "multi-frequency").otherwise(frequency)
    capital = F.concat(F.upper(F.substring(frequency, 1, 1)), F.lower(F.expr("substring(coalesce(frequency, 'daily'), 2)")))
    grouped = F.when(many, F.concat(F.lit("multi-frequency ("), frequency, F.lit(") aggregated"))).otherwise(
        F.concat(capital, F.lit(" aggregated"))
    )
    named = F.concat(long_name, F.lit(" ("), variable, F.lit(")"))
    regional = F.col("region_set").isNotNull() & (F.col("region_set") != "")
    alternative = F.concat(
        F.when(regional, "ERA5 aggregated by NUTS levels - ").otherwise("ERA5 gridded - "),
        named,
        F.lit(" - "),
        label,
    )
    described = F.concat(
        grouped,
        F.lit(" ERA5 "),
        named,
        F.when(regional, F.concat(F.lit(" data for European "), F.col("region_set"), F.lit(" regions."))).otherwise(
            " gridded data for Europe."
        ),
    )
    spatial = spatial_text()
    start, end = F.col("start_date"), F.col("end_date")
    # Field names and constant texts of the metadata standard used.
    entries = {
        "dc:title": F.concat(F.lit(publisher.prefix), long_name),
        "dcterms:alternative": alternative,
        "dc:description": F.coalesce(F.col("description"), described),
        "dc:creator": F.lit(publisher.creator),
        "dc:contributor": F.lit(publisher.contributor),
        "dc:publisher": F.lit(publisher.publisher),
        "dc:subject": F.concat(F.lit("climate change, ERA5, "), variable, F.lit(", NUTS, Europe")),
        "dcterms:created": F.lit(now),
        "dcterms:valid": F.concat(start, F.lit("/"), end),
        "dcterms:modified": F.lit(now),
        "dc:type": F.lit("Dataset"),
        "dc:format": F.lit("application/zarr"),
        "dcterms:medium": F.lit("Cloud Storage (S3)"),
        "dc:source": F.lit("Copernicus Climate Data Store (https://doi.org/10.24381/cds.4991cf48)"),
        "dc:language": F.lit("en"),
        "dcterms:conformsTo": F.lit("CF-1.8; RO-Crate 1.1"),
        "dc:coverage": coverage(spatial),
        "dcterms:temporal": F.concat(F.lit("start="), start, F.lit("; end="), end),
        "dcterms:spatial": spatial,
        "dc:rights": F.lit("Apache License, Version 2.0"),
        "dcterms:accessRights": F.lit("Open Access"),
        "dcterms:license": F.lit("https://www.apache.org/licenses/LICENSE-2.0"),
        "dcterms:accrualMethod": F.lit("Automated monthly ingestion via CDS API"),
        "dcterms:accrualPeriodicity": F.lit("Monthly"),
    }
    return F.create_map(*[c for k, v in entries.items() for c in (F.lit(k), v)])


def spatial_text() -> Column:
    limits = ["westlimit", "eastlimit", "southlimit", "northlimit"]
    places = [1, 3, 2, 0]
    text = F.concat_ws(
        ", ", *[F.concat(F.lit(f"{n}="), F.col("area")[i].cast("string")) for n, i in zip(limits, places)]
    )
    return F.when(F.col("area").isNotNull(), text).otherwise("Europe")


def coverage(place: Column) -> Column:
    return F.concat(
        place, F.lit("; "), F.substring("start_date", 1, 4), F.lit("-"), F.substring("end_date", 1, 4)
    )


def apply_descriptive(meta: DataFrame, now: str, publisher: Publisher = Publisher()) -> DataFrame:
    """Replace all attributes, keeping checkpoints and frequencies."""
    return meta.withColumn("attrs", merged(descriptive(now, publisher), functional(F.col("attrs"))))


def dynamic(now: str, publisher: Publisher = Publisher()) -> Column:
    """Only the fields that change with an update; title and description when given."""
    start, end = F.col("start_date"), F.col("end_date")
    fixed = F.create_map(
        F.lit("dcterms:modified"),
        F.lit(now),
        F.lit("dcterms:valid"),
        F.concat(start, F.lit("/"), end),
        F.lit("dcterms:temporal"),
        F.concat(F.lit("start="), start, F.lit("; end="), end),
        F.lit("dc:coverage"),
        coverage(F.lit("Europe")),
    )

    def given(key: str, value: Column, condition: Column) -> Column:
        return F.when(condition, F.create_map(F.lit(key), value)).otherwise(empty())

    def is_set(name: str) -> Column:
        return F.coalesce(F.col(name) != "", F.lit(False))

    return F.map_concat(
        fixed,
        given("dc:description", F.col("description"), is_set("description")),
        given("dc:title", F.concat(F.lit(publisher.prefix), F.col("long_name")), is_set("long_name")),
    )


def update_dynamic(meta: DataFrame, now: str, publisher: Publisher = Publisher()) -> DataFrame:
    return meta.withColumn("attrs", merged(F.col("attrs"), dynamic(now, publisher)))


def as_rows(meta: DataFrame) -> DataFrame:
    """``dataset, key, value``."""
    return meta.select("dataset", F.explode("attrs").alias("key", "value"))
