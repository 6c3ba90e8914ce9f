"""Tiles of polygons: how many, and that they decide like all edges."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from geoloom.functions import polygons
from geoloom.operators import cover, spatial
from geoloom.sources.boundaries import boundary_table


def star(n, x, y, size, seed, hole=False):
    """A ragged ring of n points around (x, y), some of it on round numbers, with a hole if asked."""
    rng = random.Random(seed)
    ring = [(x + size * r * math.cos(a), y + size * r * math.sin(a)) for a, r in ((2 * math.pi * k / n, rng.uniform(0.6, 1.0)) for k in range(n))]
    ring = [(round(px, 2), round(py, 2)) if k % 3 == 0 else (px, py) for k, (px, py) in enumerate(ring)]
    inner = [(x - size / 4, y - size / 4), (x + size / 4, y - size / 4), (x + size / 4, y + size / 4), (x - size / 4, y + size / 4)]
    return [ring, inner] if hole else [ring]


def wkt(rings):
    return "POLYGON (" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in [*r, r[0]]) + ")" for r in rings) + ")"


def edges(rings):
    return np.array([[*a, *b] for r in rings for a, b in zip(r, [*r[1:], r[0]], strict=True)])


def test_a_continent_has_few_tiles():
    continent = edges(star(5000, -100.0, 45.0, 40.0, 1, hole=True))
    tiles = list(cover.cover_tiles(continent))
    inner = [t for t in tiles if t[3] is None]
    assert 100 < len(tiles) < 10_000 and len(inner) > 50 and len({level for level, *_ in tiles}) > 3
    area = sum((cover.ACROSS / (1 << t[0])) ** 2 for t in inner)
    assert area > 0.9 * (math.pi * (40 * 0.6) ** 2 - 20 * 20)  # what every ray from the middle stays in, less the hole
    assert np.mean([len(t[3]) for t in tiles if t[3] is not None]) < 5000 / 20
    assert len(list(cover.cover_tiles(continent, most_tiles=200))) < 1000
    assert list(cover.cover_tiles(np.zeros((0, 4)))) == []
    assert len(list(cover.cover_tiles(edges([[(1.0, 1.0)]])))) == 1  # a point


def test_covers_decide_like_all_edges(spark):
    """Random points, corners, points of edges and points of tiles' sides against the predicates over
    whole shapes."""
    shapes = [(str(k), star(n, x, y, size, k, hole)) for k, (n, x, y, size, hole) in enumerate([(3, 10, 10, 1, False), (40, 12, 10, 2, True), (400, 40, 20, 15, True), (60, -179.0, 60, 0.9, False), (2000, -90, 40, 30, True), (8, 0, 0, 0.0001, False)])]
    rng = random.Random(9)
    points = set()
    for _, rings in shapes:
        for ring in rings:
            for a, b in random.Random(1).sample(list(zip(ring, [*ring[1:], ring[0]], strict=True)), min(30, len(ring))):
                points |= {a, ((a[0] + b[0]) / 2, (a[1] + b[1]) / 2), (a[0], b[1])}
        (x0, x1), (y0, y1) = ([f(c) for f in (min, max)] for c in zip(*rings[0], strict=True))
        points |= {(rng.uniform(x0, x1), rng.uniform(y0, y1)) for _ in range(200)}
        for level in range(6, 14):
            size = cover.ACROSS / (1 << level)
            points |= {(round(rng.uniform(x0, x1) / size) * size, round(rng.uniform(y0, y1) / size) * size) for _ in range(10)}
    points = [(2020, y, x) for x, y in points if -180 <= x <= 180 and -90 <= y <= 90]
    locations = spark.createDataFrame(points, "tiger_line_year int, latitude double, longitude double").dropDuplicates()
    table = boundary_table({2020: spark.createDataFrame([(k, wkt(r), 4326) for k, r in shapes], "geoid string, wkt string, srid int")})
    got = sorted(map(tuple, spatial.candidates(locations, table).collect()))
    x, y = F.col("longitude"), F.col("latitude")
    whole = locations.join(table.select("geoid", "rings"), F.lit(True)).withColumn("border", polygons.on_border(F.col("rings"), x, y)).withColumn("interior", ~F.col("border") & polygons.crosses_odd(F.col("rings"), x, y))
    plain = sorted(map(tuple, whole.filter("interior OR border").select(*spatial.LOCATION, "geoid", "interior", "border").collect()))
    assert got == plain and len(plain) > 500 and sum(r[-1] for r in plain) > 50


def test_shapes_without_rings_have_no_tile(spark):
    rows = spark.createDataFrame([(2020, "a", None), (2020, "b", []), (None, "c", [[]])], f"boundary_vintage int, geoid string, rings {polygons.RINGS}")
    assert cover.polygon_cover(rows).count() == 0 == cover.polygon_cover(rows.limit(0)).count()
