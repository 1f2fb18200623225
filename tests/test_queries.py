"""Every registered query against its SQL twin on the smallest tables."""

import oracle
import pytest

from gridclim import queries

SF_DIR = "/root/testdata/sf0.001"
queries.load_all()


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    assert oracle.compare(df, con, queries.SQL[name], empty_ok=True) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    out = entry.entry(spark)
    assert out.columns == ["region_set", "region", "index", "time", "time_filter", "value"]
