"""Polygons as arrays of rings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def edges(rings: Column) -> Column:
    """All edges ``(x1, y1, x2, y2)`` of all rings; open rings are closed."""

    def ring_edges(ring: Column) -> Column:
        following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(
            ring,
            following,
            lambda p, q: F.struct(
                p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")
            ),
        )

    return F.flatten(F.transform(rings, ring_edges))


def inside(edge_array: Column, x: Column, y: Column) -> Column:
    """Even-odd test with half-open edges, so two regions sharing an edge never
    both hold a point on it. Holes are rings like any other."""

    def crosses(e: Column) -> Column:
        straddles = (e["y1"] > y) != (e["y2"] > y)
        # The division runs only for edges that straddle y, whose ends differ in y.
        at = e["x1"] + F.try_divide((y - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"])
        return straddles & (x < at)

    return F.size(F.filter(edge_array, crosses)) % 2 == 1


def bounds(rings: Column) -> Column:
    """Bounding box ``(x0, y0, x1, y1)``."""
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("x0"),
        F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"),
        F.array_max(ys).alias("y1"),
    )


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A rectangle as one closed ring."""

    def point(x: Column, y: Column) -> Column:
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))
