"""Whole steps from raw files to cleaned tables, batch and streaming."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.grid import with_cell
from ..functions.hashing import with_ingestion_metadata
from ..functions.names import PAIRED_COORDINATES, with_snake_names
from ..operators import census, dedup, incidents, quality, weather
from ..sources import readers, sinks
from ..streaming import ingest, upsert

#: Names that must be kept apart before they are normalised.
OVERRIDES: dict[str, Mapping[str, str]] = {"fort_worth": PAIRED_COORDINATES}
WEATHER_KEYS = ("provider", "model", "weather_query_cell_id", "weather_timestamp")
CENSUS_KEYS = ("geoid", "acs_vintage")


def bronze_rows(raw: DataFrame, source: str) -> DataFrame:
    """Normalised names, content hash, source and time of ingestion; batch or stream."""
    named = with_snake_names(raw, OVERRIDES.get(source))
    if readers.RESCUED in raw.columns:  # the rescued column keeps its leading underscore
        named = named.withColumnRenamed(readers.RESCUED.strip("_"), readers.RESCUED)
    return with_ingestion_metadata(named, source)


def ingest_batch(spark: SparkSession, source: str, path: str, target: str, *, mode: str = "overwrite") -> int:
    """Read, normalise and write one source; returns the rows of the table."""
    return sinks.write_batch(bronze_rows(readers.read_source(spark, source, path), source), target, mode=mode)


def ingest_stream(spark: SparkSession, source: str, path: str, target: str, *, checkpoint: str, schema_path: str) -> None:
    """Append what is new under path and stop."""
    stream = readers.read_source(spark, source, path, streaming=True, schema_path=schema_path)
    ingest.drain_to(bronze_rows(stream, source), target, checkpoint)


def clean_incidents(raw: Mapping[str, DataFrame], *, resolution: int = 6) -> DataFrame:
    """Canonical union, stable ids, one row per id, and the cell of each."""
    identified = incidents.guard_ids(incidents.with_incident_id(incidents.union_incidents(raw)))
    return with_cell(dedup.latest_incidents(identified), resolution=resolution)


def upsert_weather(spark: SparkSession, bronze: str, schema: T.StructType, *, log: str, checkpoint: str) -> DataFrame:
    """Upsert all new responses as hours; returns the current state."""
    hours = weather.hourly_weather(ingest.stream_table(spark, bronze, schema))
    upsert.drain_upserts(hours, log=log, checkpoint=checkpoint, deduplicate=dedup.latest_weather, keys=WEATHER_KEYS)
    return upsert.current(spark, log, WEATHER_KEYS)


def upsert_census(spark: SparkSession, bronze: str, schema: T.StructType, *, log: str, checkpoint: str) -> DataFrame:
    """Upsert all new tract rows; returns the current state."""
    tracts = census.census_tracts(ingest.stream_table(spark, bronze, schema))
    upsert.drain_upserts(tracts, log=log, checkpoint=checkpoint, deduplicate=dedup.latest_census, keys=CENSUS_KEYS)
    return upsert.current(spark, log, CENSUS_KEYS)


def rebuild_census(spark: SparkSession, bronze: str, target: str) -> quality.Report:
    """Clean the whole bronze table into target and check what was written."""
    tracts = dedup.latest_census(census.census_tracts(spark.read.parquet(bronze)))
    sinks.write_batch(tracts, target)
    return quality.validate_rebuilt_census(spark.read.parquet(target))


def check_incident_table(spark: SparkSession, path: str, *, least_time_coverage: float | None = None, raise_on_failure: bool = True) -> quality.Report:
    """The incident checks over a stored table."""
    return quality.validate_incidents(spark.read.parquet(path), least_time_coverage=least_time_coverage, raise_on_failure=raise_on_failure)
