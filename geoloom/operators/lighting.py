"""Sun position and lighting class per cell and hour, computed once per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import with_center
from ..functions.solar import SOLAR_MODEL_VERSION, lighting_class, with_solar_angles
from ..sources.sinks import new_rows, rebuild_or_add
from .quality import Report, validate_lighting

DEFINITION_VERSION = "solar_elevation_twilight_v1"
KEYS = ("weather_query_cell_id", "solar_timestamp_hour", "lighting_definition_version")


def lighting_keys(events: DataFrame, *, version: str = DEFINITION_VERSION) -> DataFrame:
    """Distinct (cell, hour, version) of events that have a cell and a time."""
    given = events.filter("weather_query_cell_id IS NOT NULL AND occurred_at IS NOT NULL")
    return given.select("weather_query_cell_id", F.date_trunc("hour", F.col("occurred_at")).alias("solar_timestamp_hour"), F.lit(version).alias("lighting_definition_version")).dropDuplicates(KEYS)


def missing_keys(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    return new_rows(wanted, existing, KEYS)


def lighting_conditions(keys: DataFrame) -> DataFrame:
    """Angles, class and lineage for keys; the place is the cell's centre. A plain projection."""
    placed = with_center(keys)
    angles = with_solar_angles(placed, at="solar_timestamp_hour", latitude="query_latitude", longitude="query_longitude")
    return angles.select(
        "weather_query_cell_id",
        "solar_timestamp_hour",
        "query_latitude",
        "query_longitude",
        "solar_elevation_deg",
        "apparent_solar_elevation_deg",
        "solar_zenith_deg",
        "solar_azimuth_deg",
        lighting_class(F.col("solar_elevation_deg")).alias("lighting_condition"),
        (F.col("solar_elevation_deg") >= 0).alias("is_daylight"),
        F.lit(SOLAR_MODEL_VERSION).alias("solar_model_version"),
        "lighting_definition_version",
        F.current_timestamp().alias("computed_at"),
    )


def materialize_lighting(spark: SparkSession, events: DataFrame, path: str, *, version: str = DEFINITION_VERSION, rebuild: bool = False) -> Report:
    """Compute all keys, or those that the table at path lacks, and check the table that results."""
    wanted = lighting_keys(events, version=version)

    def build(existing: DataFrame | None) -> DataFrame:
        return lighting_conditions(wanted if existing is None else missing_keys(wanted, existing))

    rebuild_or_add(spark, path, build, keys=KEYS, rebuild=rebuild)
    table = spark.read.parquet(path).filter(F.col("lighting_definition_version") == version)
    return validate_lighting(table, version=version)
