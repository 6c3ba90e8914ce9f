"""Rings of polygons as arrays, from WKT, and predicates on them.

A shape is an array of rings, a ring an array of (x, y). All rings of a shape count by the even-odd
rule, so holes are open.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS = "array<array<struct<x:double,y:double>>>"


def rings_from_wkt(wkt: Column) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON text; null for anything else."""
    shape = F.upper(F.trim(wkt)).rlike(r"^(MULTI)?POLYGON\s*\(")
    rings = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))

    def points(ring: Column) -> Column:
        return F.transform(F.split(ring, ","), lambda p: _point(F.split(F.trim(p), r"\s+")))

    return F.when(shape, F.transform(rings, points))


def _point(pair: Column) -> Column:
    return F.struct(F.get(pair, 0).try_cast("double").alias("x"), F.get(pair, 1).try_cast("double").alias("y"))


def _edges(ring: Column) -> Column:
    """Pairs of successive points, the last joined to the first."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, following, lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def _all_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, _edges))


def on_border(rings: Column, x: Column, y: Column) -> Column:
    """The point lies on an edge, exactly."""
    return on_edge(_all_edges(rings), x, y)


def crosses_odd(rings: Column, x: Column, y: Column) -> Column:
    """A ray to the right crosses an odd number of edges."""
    return crosses_odd_edges(_all_edges(rings), x, y)


def on_edge(edges: Column, x: Column, y: Column) -> Column:
    """The same as on_border, of edges (x1, y1, x2, y2)."""

    def touches(e: Column) -> Column:
        turn = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        return (turn == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))

    return F.exists(edges, touches)


def crosses_odd_edges(edges: Column, x: Column, y: Column) -> Column:
    """The same as crosses_odd, of edges (x1, y1, x2, y2)."""

    def crossed(e: Column) -> Column:
        straddles = (e["y1"] > y) != (e["y2"] > y)
        return straddles & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"])

    return F.size(F.filter(edges, crossed)) % 2 == 1


def bounds(rings: Column) -> dict[str, Column]:
    """Box around all rings."""
    xs = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["x"])))
    ys = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["y"])))
    return {"min_x": F.array_min(xs), "max_x": F.array_max(xs), "min_y": F.array_min(ys), "max_y": F.array_max(ys)}
