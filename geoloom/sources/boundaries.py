"""Tables of polygons with a boundary vintage, and small literal tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.polygons import bounds, rings_from_wkt

SRID = 4326
CALENDAR = "acs_vintage int, acs_release_date date, tiger_line_year int, tract_definition_vintage string"


def boundary_table(shapes: Mapping[int, DataFrame], *, geoid: str = "geoid", wkt: str = "wkt", srid: str = "srid") -> DataFrame:
    """Union of yearly WKT tables: boundary_vintage, geoid, rings, box and srid.

    A row with another reference system than 4326, or a shape that does not parse, is an error.
    """
    tables = [df.select(F.lit(year).cast("int").alias("boundary_vintage"), F.col(geoid).alias("geoid"), rings_from_wkt(F.col(wkt)).alias("rings"), F.col(srid).cast("int").alias("srid")) for year, df in sorted(shapes.items())]
    if not tables:
        raise ValueError("no boundary table given")
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other)
    wrong = out.filter((F.coalesce(F.col("srid"), F.lit(-1)) != SRID) | F.col("rings").isNull()).select("boundary_vintage", "geoid", "srid").limit(5).collect()
    if wrong:
        raise ValueError(f"boundaries outside EPSG:{SRID} or without a polygon: {wrong}")
    return out.withColumns(bounds(F.col("rings")))


def write_boundaries(df: DataFrame, path: str) -> None:
    """Laid out by vintage, neighbouring shapes together, so that scans skip what they don't need."""
    df.repartitionByRange("boundary_vintage", "min_x", "min_y").sortWithinPartitions("boundary_vintage", "min_x", "min_y").write.mode("overwrite").partitionBy("boundary_vintage").parquet(path)


def release_calendar(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A literal calendar: (vintage, release date, boundary year, tract definition)."""
    return spark.createDataFrame(rows, CALENDAR)
