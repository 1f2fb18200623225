"""Outlines cut by rows of tiles, against a plain even-odd test of every cell."""

import math
import random

import pytest
from gridclim.operators import regions
from pyspark.sql import functions as F

SCHEMA = "region_set string, region string, rings array<array<struct<x double, y double>>>"


def star(n, cx, cy, size, seed):
    rng = random.Random(seed)
    angles = [2 * math.pi * k / n for k in range(n)]
    return [(cx + size * rng.uniform(0.5, 1) * math.cos(a), cy + size * rng.uniform(0.5, 1) * math.sin(a)) for a in angles]


def holds(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


OUTLINES = {
    "square": [[(0.0, 0.0), (6.0, 0.0), (6.0, 6.0), (0.0, 6.0)]],
    "hole": [[(1.0, 1.0), (9.0, 1.0), (9.0, 9.0), (1.0, 9.0)], [(3.25, 3.0), (7.0, 3.0), (7.0, 7.0), (3.0, 7.0)]],
    "star": [star(60, 4.1, 3.7, 4.0, 1)],
    "negative": [[(-3.5, -2.25), (1.5, -2.0), (0.25, 3.0)]],
    "sliver": [[(0.0, 2.5), (9.0, 2.5), (9.0, 2.6)]],
}


@pytest.fixture(scope="module")
def outlines(spark):
    return spark.createDataFrame([("S", n, r) for n, r in OUTLINES.items()], SCHEMA)


@pytest.mark.parametrize("tile", [0.5, 1.0, 3.0, 50.0])
def test_same_cells_as_plainly(spark, outlines, tile):
    points = [(i * 0.25 - 5, j * 0.25 - 5) for i in range(64) for j in range(64)]
    cells = spark.createDataFrame([(y, x) for x, y in points], "lat double, lon double")
    got = {(r.region, r.lon, r.lat) for r in regions.cells_inside(cells, outlines, tile).collect()}
    assert got == {(n, x, y) for n, rings in OUTLINES.items() for x, y in points if holds(rings, x, y)}


def test_a_long_outline_is_kept_about_once(spark):
    n = 10_000
    ring = [(30 + 25 * math.cos(2 * math.pi * k / n), 45 + 25 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    shape = spark.createDataFrame([("S", "round", [ring])], SCHEMA)
    kept = regions.row_edges(regions.outline_edges(shape), 1.0).agg(F.sum(F.size("edges"))).first()[0]
    assert n <= kept <= 2 * n
    tiles = {r["touched"]: r["count"] for r in regions.outline_tiles(shape, 1.0).groupBy("touched").count().collect()}
    assert tiles[False] > 1500 > 400 > tiles[True]  # the disc's area is 1,963 tiles
