"""The registered queries against SQL, on the smallest tables."""

import oracle
import pytest
from gridclim.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert oracle.compare(df, oracle.duck(SF), queries.SQL[name]) is None


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
