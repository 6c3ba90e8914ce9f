"""Point-in-polygon mapping by boundary vintage, as an equality join on tiles of polygon covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import valid_location
from ..functions.polygons import crosses_odd_edges, on_edge
from ..sources.boundaries import SRID
from ..sources.scratch import written
from ..sources.sinks import new_rows, rebuild_or_add
from .cover import polygon_cover, tile_of
from .dedup import guard_unique

LOCATION = ("tiger_line_year", "latitude", "longitude")


def unique_locations(df: DataFrame) -> DataFrame:
    """Distinct (year, latitude, longitude) of rows with a year and a valid location."""
    return df.filter(F.col("tiger_line_year").isNotNull() & valid_location()).select(*LOCATION).dropDuplicates(LOCATION)


def candidates(locations: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Pairs of a location and a polygon around it: interior, or on the border, as two flags.

    Polygons are covered by tiles of their own sizes, see cover; a point lies in one tile of each
    size, so the join is an equality on year, size and tile, and a pair comes once. Inner tiles match
    as they are; only in border tiles are edges looked at, and only those near the tile. Where points
    crowd one tile, Spark splits its partition. The cover is written to the shared folder first.
    """
    cover = written(polygon_cover(boundaries).withColumnRenamed("boundary_vintage", "tiger_line_year"), "polygon-cover")
    x, y = F.col("longitude"), F.col("latitude")
    sizes = cover.agg(F.array_sort(F.collect_set("level"))).scalar()  # a number a level
    points = locations.select(*LOCATION, F.explode(sizes).alias("level"))
    points = points.withColumns({"i": tile_of(x, F.col("level")), "j": tile_of(y, F.col("level"))})
    near = points.join(cover, ["tiger_line_year", "level", "i", "j"])
    flagged = near.withColumn("border", ~F.col("inner") & on_edge(F.col("edges"), x, y))
    flagged = flagged.withColumn("interior", F.col("inner") | (~F.col("border") & crosses_odd_edges(F.col("edges"), x, y)))
    return flagged.filter("interior OR border").select(*LOCATION, "geoid", "interior", "border")


def map_locations(locations: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Every location once, with tract_geoid.

    A strict interior match comes first; two are an error, as tracts don't overlap. Otherwise a
    match that includes the border counts if it is the only one. All others keep a null tract.
    """
    per_point = candidates(locations, boundaries).groupBy(*LOCATION).agg(
        F.count_distinct(F.when(F.col("interior"), F.col("geoid"))).alias("insides"),
        F.min(F.when(F.col("interior"), F.col("geoid"))).alias("inside"),
        F.count_distinct("geoid").alias("covers"),
        F.min("geoid").alias("cover"),
    )
    several = F.raise_error(F.concat_ws(" ", F.lit("location lies inside several polygons:"), *(F.col(c).cast("string") for c in LOCATION)))
    tract = F.when(F.col("insides") > 1, several).when(F.col("insides") == 1, F.col("inside")).when(F.col("covers") == 1, F.col("cover"))
    return locations.join(per_point.select(*LOCATION, tract.alias("tract_geoid")), list(LOCATION), "left")


def materialize_location_map(spark: SparkSession, candidates_df: DataFrame, boundaries: DataFrame, path: str, *, rebuild: bool = False) -> DataFrame:
    """Map all locations, or only those that the table at path does not have; return the table."""

    def build(existing: DataFrame | None) -> DataFrame:
        wanted = candidates_df if existing is None else new_rows(candidates_df, existing, LOCATION)
        return map_locations(wanted, boundaries)

    rebuild_or_add(spark, path, build, keys=LOCATION, rebuild=rebuild)
    return guard_unique(spark.read.parquet(path), LOCATION, name="location map")


def missing_vintages(calendar: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Boundary years that the calendar names and the boundary table lacks."""
    have = boundaries.select(F.col("boundary_vintage").alias("tiger_line_year")).distinct()
    return calendar.select("tiger_line_year").distinct().join(have, "tiger_line_year", "left_anti")


def validate_boundaries(calendar: DataFrame, boundaries: DataFrame) -> None:
    lacking = [r[0] for r in missing_vintages(calendar, boundaries).orderBy("tiger_line_year").limit(50).collect()]
    if lacking:
        raise ValueError(f"no boundaries for years {lacking}")
    if not boundaries.filter(F.coalesce(F.col("srid"), F.lit(-1)) != SRID).isEmpty():
        raise ValueError(f"boundaries outside EPSG:{SRID}")
    guard_unique(boundaries, ["boundary_vintage", "geoid"], name="boundaries")
