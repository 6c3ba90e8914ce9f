"""Covers of polygons by tiles of many sizes, each fitted to its polygon.

Tiles halve from level to level. A tile that no edge meets lies inside or outside as a whole: inner
tiles are kept without edges and match without a predicate. A tile that edges meet is split while it
is worth it; what is left are border tiles, each with the few edges that decide for its points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Degrees across the one tile of level 0, from -180 on both axes.
ACROSS = 360.0
FINEST = 24
#: A border tile is split while more edges than this decide for its points, and at first anyway.
FEW_EDGES, FIRST_SPLITS, MOST_SPLITS = 16, 2, 8
#: Tiles of a polygon, about: beyond that border tiles stay as they are.
MOST_TILES = 8000
#: Tiles are met a little beyond their sides, so that rounding puts no point into a wrong one.
_MARGIN = 1e-9

_COVER = "boundary_vintage int, geoid string, level int, i long, j long, inner boolean, edges array<struct<x1:double,y1:double,x2:double,y2:double>>"


def tile_of(value: Column, level: Column) -> Column:
    return F.floor((value + ACROSS / 2) * F.pow(F.lit(2.0), level) / ACROSS).cast("long")


def _edges_of(rings: pa.Array) -> np.ndarray:
    """(n, 4) of a list of rings: successive points, the last joined to the first."""
    parts = []
    for k in range(len(rings)):
        points = rings.slice(k, 1).flatten()
        at = np.stack([np.asarray(points.field(c).to_numpy(zero_copy_only=False), float) for c in ("x", "y")], axis=1) if len(points) else np.zeros((0, 2))
        parts.append(np.concatenate([at, np.roll(at, -1, axis=0)], axis=1))
    edges = np.concatenate(parts) if parts else np.zeros((0, 4))
    return edges[np.isfinite(edges).all(axis=1)]


def _meets(edges: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """Which edges may touch a box: boxes overlap, and its corners are not all on one side."""
    low, high = np.minimum(edges[:, :2], edges[:, 2:]), np.maximum(edges[:, :2], edges[:, 2:])
    near = (low[:, 0] <= x1) & (high[:, 0] >= x0) & (low[:, 1] <= y1) & (high[:, 1] >= y0)
    dx, dy = edges[:, 2] - edges[:, 0], edges[:, 3] - edges[:, 1]
    sides = np.stack([dx * (y - edges[:, 1]) - dy * (x - edges[:, 0]) for x in (x0, x1) for y in (y0, y1)])
    return near & ~((sides > 0).all(axis=0) | (sides < 0).all(axis=0))


def _inside(edges: np.ndarray, x: float, y: float) -> bool:
    some = edges[(edges[:, 1] > y) != (edges[:, 3] > y)]
    crossing = (some[:, 2] - some[:, 0]) * (y - some[:, 1]) / (some[:, 3] - some[:, 1]) + some[:, 0]
    return bool((x < crossing).sum() % 2)


def cover_tiles(edges: np.ndarray, *, most_tiles: int = MOST_TILES) -> Iterator[tuple[int, int, int, np.ndarray | None]]:
    """(level, i, j, edges) of a polygon's tiles; no edges: an inner tile.

    The edges of a border tile are all that a ray to the right can cross from one of its points, and
    all that such a point can lie on.
    """
    if not len(edges):
        return
    xs, ys = edges[:, [0, 2]], edges[:, [1, 3]]
    extent = max(xs.max() - xs.min(), ys.max() - ys.min(), ACROSS / (1 << FINEST))
    coarse = int(np.clip(np.floor(np.log2(ACROSS / extent)), 0, FINEST))
    size = ACROSS / (1 << coarse)
    first = lambda v: int(np.floor((v + ACROSS / 2) / size))
    todo = [(coarse, i, j, edges) for i in range(first(xs.min() - _MARGIN), first(xs.max() + _MARGIN) + 1) for j in range(first(ys.min() - _MARGIN), first(ys.max() + _MARGIN) + 1)]
    given = 0
    while todo:
        after = []
        for level, i, j, before in todo:
            size = ACROSS / (1 << level)
            x0, y0 = i * size - ACROSS / 2 - _MARGIN, j * size - ACROSS / 2 - _MARGIN
            x1, y1 = x0 + size + 2 * _MARGIN, y0 + size + 2 * _MARGIN
            # edges beside the tile or to its right; those of a tile are among those of its parent
            strip = before[(np.maximum(before[:, 0], before[:, 2]) >= x0) & (np.maximum(before[:, 1], before[:, 3]) >= y0) & (np.minimum(before[:, 1], before[:, 3]) <= y1)]
            if not _meets(strip, x0, y0, x1, y1).any():
                if _inside(strip, (x0 + x1) / 2, (y0 + y1) / 2):
                    given += 1
                    yield level, i, j, None
                continue
            depth = level - coarse
            worth = depth < FIRST_SPLITS or (len(strip) > FEW_EDGES and depth < MOST_SPLITS)
            if worth and level < FINEST and given + len(after) + len(todo) < most_tiles:
                after += [(level + 1, 2 * i + a, 2 * j + b, strip) for a in (0, 1) for b in (0, 1)]
            else:
                given += 1
                yield level, i, j, strip
        todo = after


def polygon_cover(boundaries: DataFrame, *, most_tiles: int = MOST_TILES) -> DataFrame:
    """A row per tile of each polygon (boundary_vintage, geoid, rings): _COVER.

    A polygon without a ring has no tile. Polygons are worked on one after the other within tasks.
    """

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")])
        for batch in batches:
            for n in range(batch.num_rows):
                if not batch["rings"][n].is_valid:
                    continue
                tiles = list(cover_tiles(_edges_of(batch["rings"].slice(n, 1).flatten()), most_tiles=most_tiles))
                for a in range(0, len(tiles), 1000):
                    level, i, j, edges = zip(*tiles[a : a + 1000], strict=True)
                    flat = np.concatenate([e for e in edges if e is not None] or [np.zeros((0, 4))])
                    ends = np.cumsum([0, *(0 if e is None else len(e) for e in edges)])
                    listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(4)], fields=list(edge)))
                    same = len(level)
                    yield pa.record_batch({
                        "boundary_vintage": pa.array([batch["boundary_vintage"][n].as_py()] * same, pa.int32()),
                        "geoid": pa.array([batch["geoid"][n].as_py()] * same, pa.string()),
                        "level": pa.array(level, pa.int32()),
                        "i": pa.array(i, pa.int64()),
                        "j": pa.array(j, pa.int64()),
                        "inner": pa.array([e is None for e in edges]),
                        "edges": listed,
                    })

    return boundaries.select(F.col("boundary_vintage").cast("int").alias("boundary_vintage"), F.col("geoid").cast("string").alias("geoid"), "rings").mapInArrow(cover, _COVER)
