"""Commits, labels and attributes beside datasets, and what updates read."""

import datetime as dt

import pytest
from gridclim.plans import describe, incremental, index_run, ingest
from gridclim.session import scratch_dir
from gridclim.sources import journal, store, tables
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def days(spark):
    return tables.grid_daily(spark, SF).select("time", "lat", "lon", "pr").where("time < '2000-03-01'").cache()


@pytest.fixture
def about(spark, days):
    about = ingest.grid_journal(spark, scratch_dir(spark), ["pr"], "then", cells=days)
    journal.create(about, store.with_year(days.where("time < '1999-06-01'")))
    return about


def test_commits(about, days, spark):
    assert about.latest() == journal.Commit(0, True, None)
    assert incremental.update_grid(spark, about.path, days, dt.date(2000, 1, 31), about)
    assert about.latest() == journal.Commit(1, True, (1999, 2000))
    assert not incremental.update_grid(spark, about.path, days, dt.date(2000, 1, 31), about)
    assert about.latest().version == 1
    named = lambda df: {(r["year"], r["time"]) for r in df.collect()}
    assert named(about.held()) == named(describe.grid_labels(spark.read.parquet(about.path)))


def test_open_commits_add_up(about, days, spark):
    about.begin([1999])
    about.begin([2000])
    assert about.latest() == journal.Commit(2, False, (1999, 2000))
    assert about.attributes().count() == 1  # those of the last one that was done
    # labels of open years come from the dataset, the others from the table
    store.with_year(days.where("year(time) = 2000")).write.mode("append").partitionBy("year").parquet(about.path)
    assert about.held().where("year = 2000").count() == days.where("year(time) = 2000").select("time").distinct().count()
    assert incremental.update_grid(spark, about.path, days, dt.date(2000, 2, 29), about)
    assert about.latest() == journal.Commit(3, True, (1999, 2000))
    assert spark.read.parquet(about.path).count() == days.count()


def test_broken_creation_is_done_again(spark, days):
    about = ingest.grid_journal(spark, scratch_dir(spark), ["pr"], "then", cells=days)
    about.begin(None)
    assert not store.exists(spark, about.path) and about.attributes().isEmpty()
    journal.create(about, store.with_year(days))
    assert about.latest() == journal.Commit(1, True, None) and about.attributes().count() == 1


def test_what_is_due_is_not_scanned_for(about, days, spark):
    files = about.held().inputFiles()
    assert files and all("grid-labels" in f for f in files)


def test_attributes_are_refreshed_and_kept(about, days, spark):
    incremental.update_grid(spark, about.path, days, dt.date(2000, 1, 31), ingest.grid_journal(spark, about.path.removesuffix("/grid"), ["pr"], "now"))
    attrs = about.attributes().first()["attrs"]
    assert attrs["dcterms:created"] == "then" and attrs["dcterms:modified"] == "now"
    assert attrs["dcterms:valid"].endswith("/2000-01-31") and attrs["dcterms:spatial"].startswith("westlimit=")


def test_sources_are_checked(spark, days):
    with pytest.raises(FileNotFoundError, match="tasmax"):
        index_run.check_sources(days, ("tx30", "r20mm"))
    regular = spark.range(100).select(F.date_add(F.lit("1999-01-01").cast("date"), F.col("id").cast("int")).alias("time"), F.lit(1.0).alias("pr"))
    index_run.check_sources(regular, ("r20mm",))
    with pytest.raises(ValueError, match="irregular"):
        index_run.check_sources(regular.where("time <> '1999-02-03'"), ("r20mm",))
    index_run.check_sources(regular.where("time <> '1999-02-03'"), ("r20mm",), sample="D")
    with pytest.raises(ValueError, match="daily"):
        index_run.check_sources(regular.where("day(time) = 1"), ("r20mm",))
