"""Special functions against Python's and against values known in closed form."""

import math

import pytest
from gridclim.functions import special
from gridclim.operators import quality
from pyspark.sql import functions as F


def test_log_gamma(spark):
    xs = [0.5, 1.0, 1.5, 2.0, 3.25, 10.0, 171.5, 15000.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", special.log_gamma(F.col("x")).alias("y")).collect():
        assert r.y == pytest.approx(math.lgamma(r.x), rel=1e-12, abs=1e-12)


def test_incomplete_beta(spark):
    """I(x; a, 1) = x^a, I(x; 1, b) = 1 - (1-x)^b, and I(x; a, b) + I(1-x; b, a) = 1."""
    rows = [(a, x) for a in (0.5, 1.0, 2.5, 40.0, 15000.0) for x in (0.0, 1e-9, 0.1, 0.5, 0.9, 0.9999, 1.0)]
    df = spark.createDataFrame(rows, "a double, x double")
    a, x, one = F.col("a"), F.col("x"), F.lit(1.0)
    out = df.select(
        "a", "x", special.incomplete_beta(a, one, x).alias("left"), special.incomplete_beta(one, a, x).alias("right"),
        (special.incomplete_beta(a, F.lit(0.5), x) + special.incomplete_beta(F.lit(0.5), a, 1 - x)).alias("both"),
    )
    for r in out.collect():
        assert r.left == pytest.approx(r.x**r.a, rel=1e-9, abs=1e-300)
        assert r.right == pytest.approx(1 - (1 - r.x) ** r.a, rel=1e-6, abs=1e-12)
        assert r.both == pytest.approx(1, abs=1e-9)


def test_p_values_by_hand(spark):
    """One degree of freedom is Cauchy's, two have a closed form; small values keep their digits."""
    rows = [(0.0, 3), (0.5, 3), (-0.9, 3), (0.3, 4), (1.0, 5), (-1.0, 50), (0.999, 4), (0.99, 32)]
    df = spark.createDataFrame(rows, "r double, n int")
    got = {(v.r, v.n): v.p for v in df.select("r", "n", special.correlation_p_value(F.col("r"), F.col("n")).alias("p")).collect()}
    for (r, n), p in got.items():
        if n == 3:
            assert p == pytest.approx(1 - 2 / math.pi * math.asin(abs(r)), rel=1e-10)
        elif n == 4:
            assert p == pytest.approx(1 - abs(r), rel=1e-9)
        elif abs(r) == 1:
            assert p == 0
    assert 0 < got[0.99, 32] < 1e-24


def test_trend_without_variation_or_values(spark):
    rows = [("a", f"2000-0{m}-01", 5.0) for m in range(1, 6)] + [("b", "2000-01-01", 1.0), ("b", "2000-02-01", None)]
    df = spark.createDataFrame(rows, "k string, t string, v double").select("k", F.to_date("t").alias("time"), "v")
    out = {r["k"]: r for r in quality.linear_trend(df, "v", ("k",)).collect()}
    assert out["a"]["slope"] == 0 and out["a"]["std_err"] == 0 and out["a"]["p_value"] is None
    assert out["b"]["slope"] is None and out["b"]["p_value"] is None and out["b"]["std_err"] is None
