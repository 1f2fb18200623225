"""Writes, layout and dataset attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import CELL
from ..session import scratch_dir
from ..sources import metadata, store, tables
from . import query
from . import sql as q
from .common import big, r6, text


@query(
    "k1_write_modes",
    q.with_(q.GRID) + "SELECT year(time) AS year, count(*) AS n, round(sum(pr), 6) AS pr FROM grid GROUP BY 1",
)
def k1(spark, sf):
    path = scratch_dir(spark)
    grid = store.with_year(tables.grid_daily(spark, sf).select("time", *CELL, "pr"))
    early = F.col("year") <= 1998
    store.write_store(grid.withColumn("pr", F.lit(-1.0)), path, "overwrite", ["year"])
    store.write_store(grid.where(early), path, "overwrite", ["year"])
    store.write_store(grid, path, "skip", ["year"])  # exists, so nothing happens
    store.write_store(grid.where(~early), path, "append", ["year"])
    stored = spark.read.parquet(path)
    return stored.groupBy(big("year").alias("year")).agg(F.count("*").alias("n"), r6(F.sum("pr")).alias("pr"))


@query(
    "k1_half_written_store",
    q.with_(q.GRID) + "SELECT year(time) AS year, count(*) AS n, round(sum(pr), 6) AS pr FROM grid GROUP BY 1",
)
def k1_half(spark, sf):
    path = scratch_dir(spark)
    grid = store.with_year(tables.grid_daily(spark, sf).select("time", *CELL, "pr"))
    # Files without a commit, as a failed job leaves them, are no store.
    marks = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    grid.where(F.col("year") <= 1998).write.option(marks, "false").parquet(path)
    store.write_store(grid, path, "skip", ["year"])
    stored = store.read_store(spark, path)
    return stored.groupBy(big("year").alias("year")).agg(F.count("*").alias("n"), r6(F.sum("pr")).alias("pr"))


@query(
    "k2_upsert",
    q.with_(q.GRID)
    + """, s AS (SELECT time, lat, lon, CASE WHEN time >= DATE '2000-01-15' THEN pr + 1 ELSE pr END AS pr FROM grid)
    SELECT lat, year(time) AS year, count(*) AS n, round(sum(pr), 6) AS pr FROM s GROUP BY 1, 2""",
)
def k2(spark, sf):
    path = scratch_dir(spark)
    grid = tables.grid_daily(spark, sf).select("time", *CELL, "pr")
    old = grid.where(F.col("time") <= "2000-06-30")
    new = grid.where(F.col("time") >= "2000-01-15").withColumn("pr", F.col("pr") + 1)
    store.write_store(store.with_year(old), path, partition_by=["year"])
    for _ in range(2):  # a repeated update changes nothing
        store.update_store(spark, path, new, store.GRID_KEY)
    stored = spark.read.parquet(path)
    return stored.groupBy("lat", big("year").alias("year")).agg(
        F.count("*").alias("n"), r6(F.sum("pr")).alias("pr")
    )


_META = """m AS (SELECT p_partkey AS k, 'd' || p_partkey AS dataset, ['tas', 'pr', 'tx30'][(p_partkey % 3 + 1)::INT] AS variable,
    strftime(DATE '1990-01-01' + to_days((p_partkey % 5000)::INT), '%Y-%m-%d') AS start_date,
    strftime(DATE '2010-01-01' + to_days((p_partkey % 5000)::INT), '%Y-%m-%d') AS end_date,
    CASE WHEN p_partkey % 2 = 0 THEN 'NUTS-' || (p_partkey % 4) END AS region_set,
    CASE WHEN p_partkey % 5 = 0 THEN [75.0 - p_partkey % 10, -30.0, 30.5, 50.25]::DOUBLE[] END AS area,
    CASE WHEN p_partkey % 4 = 0 THEN p_name END AS long_name, CASE WHEN p_partkey % 6 = 0 THEN p_type END AS description,
    CASE WHEN p_partkey % 3 = 2 THEN 'MS, QS-DEC, YS' ELSE 'daily' END AS frequency, p_brand, p_size FROM part)"""


def _meta(spark, sf):
    k = F.col("p_partkey")

    def date(first):
        return F.date_format(F.date_add(F.lit(first).cast("date"), (k % 5000).cast("int")), "yyyy-MM-dd")

    return tables.table(spark, sf, "part").select(
        k.alias("k"),
        F.concat(F.lit("d"), text(k)).alias("dataset"),
        F.array(F.lit("tas"), F.lit("pr"), F.lit("tx30"))[(k % 3).cast("int")].alias("variable"),
        date("1990-01-01").alias("start_date"),
        date("2010-01-01").alias("end_date"),
        F.when(k % 2 == 0, F.concat(F.lit("NUTS-"), text(k % 4))).alias("region_set"),
        F.when(
            k % 5 == 0, F.array((F.lit(75.0) - k % 10), F.lit(-30.0), F.lit(30.5), F.lit(50.25))
        ).alias("area"),
        F.when(k % 4 == 0, F.col("p_name")).alias("long_name"),
        F.when(k % 6 == 0, F.col("p_type")).alias("description"),
        F.when(k % 3 == 2, "MS, QS-DEC, YS").otherwise("daily").alias("frequency"),
        "p_brand",
        "p_size",
    )


def _map(**entries):
    return F.create_map(*[c for key, v in entries.items() for c in (F.lit(key.replace("__", ":")), v)])


@query(
    "k3_merge_attributes",
    q.with_(_META)
    + q.union(
        *[
            f"SELECT dataset, '{key}' AS key, {value} AS value FROM m"
            for key, value in {
                "brand": "p_brand",
                "last_checkpoint_MS": "end_date",
                "dcterms:valid": "start_date || '/' || end_date",
                "dc:title": "'old'",
                "dcterms:modified": "'new'",
            }.items()
        ]
    ),
)
def k3(spark, sf):
    lit = F.lit
    old = _map(
        brand=F.col("p_brand"),
        last_checkpoint_MS=F.col("start_date"),
        dcterms__valid=lit("x"),
        dc__title=lit("old"),
        start_date=F.col("start_date"),
        last_updated=lit("y"),
        end_date=lit("z"),
        original_frequency=lit("D"),
    )
    new = _map(
        last_checkpoint_MS=F.col("end_date"),
        dcterms__valid=F.concat_ws("/", "start_date", "end_date"),
        dc__title=lit("ignored"),
        dcterms__modified=lit("new"),
        other=lit("ignored"),
    )
    merged = metadata.merge_on_update(old, new, keys=["last_checkpoint_MS", "absent"])
    return metadata.as_rows(_meta(spark, sf).select("dataset", merged.alias("attrs")))


@query(
    "k4_compact_types",
    q.with_(q.GRID)
    + """SELECT lat, lon, count(*) AS n, round(max(CAST(CAST(tas AS FLOAT) AS DOUBLE)), 6) AS tas,
      round(sum(CAST(CAST(pr AS FLOAT) AS DOUBLE)), 6) AS pr FROM grid GROUP BY 1, 2""",
)
def k4(spark, sf):
    path = scratch_dir(spark)
    store.write_compact(tables.grid_daily(spark, sf).select("time", *CELL, "tas", "pr"), path)
    stored = spark.read.parquet(path)
    return stored.groupBy(*CELL).agg(
        F.count("*").alias("n"),
        r6(F.max(F.col("tas").cast("double"))).alias("tas"),
        r6(F.sum(F.col("pr").cast("double"))).alias("pr"),
    )


@query(
    "k5_compact_files",
    q.with_(q.GRID) + "SELECT lat, lon, count(*) AS n, round(sum(pr), 6) AS pr FROM grid GROUP BY 1, 2",
)
def k5(spark, sf):
    grid = tables.grid_daily(spark, sf).select("time", *CELL, "pr")
    early = F.col("time") < "1998-01-01"
    paths = [scratch_dir(spark), scratch_dir(spark)]
    for path, part in zip(paths, (grid.where(early), grid.where(~early))):
        store.write_store(part, path)
    out = store.compact_files(spark, paths, scratch_dir(spark))
    return out.groupBy(*CELL).agg(F.count("*").alias("n"), r6(F.sum("pr")).alias("pr"))


@query(
    "k6_grid_tiles",
    q.with_(q.GRID, q.CELLS)
    + """, a AS (SELECT lat, (row_number() OVER (ORDER BY lat) - 1) // 100 AS tile_lat FROM (SELECT DISTINCT lat FROM cells)),
    o AS (SELECT lon, (row_number() OVER (ORDER BY lon) - 1) // 100 AS tile_lon FROM (SELECT DISTINCT lon FROM cells))
    SELECT tile_lat, tile_lon, lat, count(*) AS n FROM grid JOIN a USING (lat) JOIN o USING (lon) GROUP BY 1, 2, 3""",
)
def k6(spark, sf):
    tiled = store.with_tiles(tables.grid_daily(spark, sf))
    return tiled.groupBy("tile_lat", "tile_lon", "lat").agg(F.count("*").alias("n"))


@query(
    "k6_region_tiles",
    """WITH r AS (SELECT 'set' || (c_custkey % 2) AS region_set, 'c' || c_custkey AS region FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 10 = 1),
      k AS (SELECT *, row_number() OVER (PARTITION BY region_set ORDER BY region) - 1 AS rank, count(*) OVER (PARTITION BY region_set) AS size FROM r)
    SELECT region_set, CASE WHEN size <= 400 THEN rank ELSE rank // 50 END AS tile_region, count(*) AS n,
      min(region) AS first FROM k GROUP BY 1, 2""",
)
def k6_regions(spark, sf):
    k = F.col("c_custkey")
    named = tables.table(spark, sf, "customer").where((k % 2 == 0) | (k % 10 == 1)).select(
        F.concat(F.lit("set"), text(k % 2)).alias("region_set"), F.concat(F.lit("c"), text(k)).alias("region")
    )
    tiled = store.with_region_tiles(named)
    return tiled.groupBy("region_set", big("tile_region").alias("tile_region")).agg(
        F.count("*").alias("n"), F.min("region").alias("first")
    )


def _with_attrs(spark, sf):
    attrs = _map(
        GRIB_paramId=text("k"), GRIB_edition=F.lit("1"), units=F.lit("K"), brand=F.col("p_brand"),
        frequencies_used=F.lit("MS, YS"), last_checkpoint_MS=F.col("end_date"), note_GRIB_=F.lit("kept"),
    )
    return _meta(spark, sf).withColumn("attrs", attrs)


@query("k7_drop_all_attributes", q.with_(_META) + "SELECT dataset, CAST(0 AS BIGINT) AS attributes FROM m")
def k7(spark, sf):
    return metadata.drop_all(_with_attrs(spark, sf)).select("dataset", big(F.size("attrs")).alias("attributes"))


@query(
    "k8_drop_grib_attributes",
    q.with_(_META)
    + q.union(
        *[
            f"SELECT dataset, '{k}' AS key, {v} AS value FROM m"
            for k, v in {
                "units": "'K'", "brand": "p_brand", "frequencies_used": "'MS, YS'",
                "last_checkpoint_MS": "end_date", "note_GRIB_": "'kept'",
            }.items()
        ]
    ),
)
def k8(spark, sf):
    return metadata.as_rows(metadata.drop_grib(_with_attrs(spark, sf)))


_NOW = "2025-01-31T12:00:00Z"
_LN = "coalesce(long_name, variable)"
_SPATIAL = (
    "CASE WHEN area IS NULL THEN 'Europe' ELSE 'westlimit=' || area[2] || ', eastlimit=' || area[4] || "
    "', southlimit=' || area[3] || ', northlimit=' || area[1] END"
)
_FIELDS = {
    "dc:title": f"'Climate: ' || {_LN}",
    "dcterms:alternative": "CASE WHEN region_set IS NULL THEN 'ERA5 gridded - ' ELSE 'ERA5 aggregated by NUTS levels - ' END || "
    f"{_LN} || ' (' || variable || ') - ' || CASE WHEN contains(frequency, ',') THEN 'multi-frequency' ELSE frequency END",
    "dc:description": "coalesce(description, CASE WHEN contains(frequency, ',') THEN 'multi-frequency (' || frequency || ') aggregated' "
    f"ELSE 'Daily aggregated' END || ' ERA5 ' || {_LN} || ' (' || variable || ')' || CASE WHEN region_set IS NULL "
    "THEN ' gridded data for Europe.' ELSE ' data for European ' || region_set || ' regions.' END)",
    "dc:creator": "'Example Institute'",
    "dc:contributor": "'unknown'",
    "dc:publisher": "'Example Press'",
    "dc:subject": "'climate change, ERA5, ' || variable || ', NUTS, Europe'",
    "dcterms:created": f"'{_NOW}'",
    "dcterms:valid": "start_date || '/' || end_date",
    "dcterms:modified": f"'{_NOW}'",
    "dc:type": "'Dataset'",
    "dc:format": "'application/zarr'",
    "dcterms:medium": "'Cloud Storage (S3)'",
    "dc:source": "'Copernicus Climate Data Store (https://doi.org/10.24381/cds.4991cf48)'",
    "dc:language": "'en'",
    "dcterms:conformsTo": "'CF-1.8; RO-Crate 1.1'",
    "dc:coverage": f"({_SPATIAL}) || '; ' || start_date[1:4] || '-' || end_date[1:4]",
    "dcterms:temporal": "'start=' || start_date || '; end=' || end_date",
    "dcterms:spatial": _SPATIAL,
    "dc:rights": "'Apache License, Version 2.0'",
    "dcterms:accessRights": "'Open Access'",
    "dcterms:license": "'https://www.apache.org/licenses/LICENSE-2.0'",
    "dcterms:accrualMethod": "'Automated monthly ingestion via CDS API'",
    "dcterms:accrualPeriodicity": "'Monthly'",
}
_PUBLISHER = metadata.Publisher("Example Institute", publisher="Example Press", prefix="Climate: ")


def _fields_sql(fields: dict[str, str]) -> str:
    entries = ", ".join(f"{{'k': '{k}', 'v': {v}}}" for k, v in fields.items())
    return f"SELECT dataset, e.k AS key, e.v AS value FROM (SELECT dataset, unnest([{entries}]) AS e FROM m)"


@query("k9_descriptive_metadata", q.with_(_META) + _fields_sql(_FIELDS))
def k9(spark, sf):
    meta = _meta(spark, sf).withColumn("attrs", metadata.descriptive(_NOW, _PUBLISHER))
    return metadata.as_rows(meta)


@query(
    "k10_apply_metadata",
    q.with_(_META) + _fields_sql({**_FIELDS, "frequencies_used": "'MS, YS'", "last_checkpoint_MS": "end_date"}),
)
def k10(spark, sf):
    return metadata.as_rows(metadata.apply_descriptive(_with_attrs(spark, sf), _NOW, _PUBLISHER))


_OLD = {"units": "'K'", "brand": "p_brand"}
_DYNAMIC = {
    "dcterms:modified": f"'{_NOW}'",
    "dcterms:valid": "start_date || '/' || end_date",
    "dcterms:temporal": "'start=' || start_date || '; end=' || end_date",
    "dc:coverage": "'Europe; ' || start_date[1:4] || '-' || end_date[1:4]",
    "dc:description": "coalesce(description, 'old')",
    "dc:title": "coalesce('Climate: ' || long_name, 'old')",
}


@query("k11_update_dynamic_metadata", q.with_(_META) + _fields_sql({**_OLD, **_DYNAMIC}))
def k11(spark, sf):
    old = _map(
        units=F.lit("K"), brand=F.col("p_brand"), dc__title=F.lit("old"), dc__description=F.lit("old"),
        dcterms__valid=F.lit("old"),
    )
    meta = _meta(spark, sf).withColumn("attrs", old)
    return metadata.as_rows(metadata.update_dynamic(meta, _NOW, _PUBLISHER))
