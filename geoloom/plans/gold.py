"""From canonical incidents to one leakage-safe feature row each, and a panel of counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import with_time_grains
from ..functions.grid import with_cell
from ..operators import asof, enrich, lighting, skew, spatial
from ..operators.dedup import guard_identities
from ..operators.quality import Report, validate_features
from ..sources.published import SparkStore, fresh_version, publish
from ..sources.scratch import discard, written


#: Tasks that the events of one tract are dealt over; the census has about 100,000 rows a year.
CENSUS_COPIES = 32


def feature_rows(
    incidents: DataFrame,
    *,
    calendar: DataFrame,
    location_map: DataFrame,
    census: DataFrame,
    weather: DataFrame,
    lighting_table: DataFrame,
    provider: str,
    model: str,
    resolution: int = 6,
    version: str = lighting.DEFINITION_VERSION,
    asked: DataFrame | None = None,
) -> DataFrame:
    """All incident columns, then time grains, vintage, tract, census, lighting and weather features.

    Every step is a left join with a guarded lookup: the result has exactly the incidents' rows.
    Popular keys are counted in the events, before any join. Tracts are known only after one, and
    their table has a row per tract and year, so it is copied instead. asked, as asked_for() makes it
    of the same incidents, saves reading these once for each lookup and each count.
    """
    events = with_time_grains(incidents)
    if "weather_query_cell_id" not in events.columns:
        events = with_cell(events, resolution=resolution)
    ranges = asof.calendar_ranges(calendar)
    out = asof.attach_vintage(events, ranges)
    asked, counted, rows = (events, out, None) if asked is None else (with_time_grains(asked), asof.attach_vintage(with_time_grains(asked), ranges), "incidents")
    at_hour = skew.hot_slots(asked, ["weather_query_cell_id", "occurred_at_hour"], rows=rows)
    out = enrich.attach_tracts(out, location_map, hot=skew.hot_slots(counted, ["tiger_line_year", "latitude", "longitude"], rows=rows))
    out = enrich.attach_socioeconomic(out, census, hot=CENSUS_COPIES)
    out = enrich.attach_lighting(out, enrich.lighting_lookup(lighting_table, version=version), hot=at_hour)
    return enrich.attach_weather(out, enrich.weather_lookup(asked, weather, provider=provider, model=model, resolution=resolution), hot=at_hour)


def asked_for(incidents: DataFrame) -> DataFrame:
    """Distinct cells, locations and hours of incidents, as occurred_at, with the number of each.

    All that lookups ask for: locations, lights, weather and popular keys follow from these rows.
    """
    hour = F.date_trunc("hour", F.col("occurred_at")).alias("occurred_at")
    return incidents.groupBy("weather_query_cell_id", "latitude", "longitude", hour).agg(F.count(F.lit(1)).alias("incidents"))


def located_events(incidents: DataFrame, calendar: DataFrame) -> DataFrame:
    """Locations to map: those of events with a vintage, by its boundary year."""
    return spatial.unique_locations(asof.attach_vintage(with_time_grains(incidents), asof.calendar_ranges(calendar)))


def run(
    spark: SparkSession,
    incidents: DataFrame,
    *,
    calendar: DataFrame,
    boundaries: DataFrame,
    census: DataFrame,
    weather: DataFrame,
    lighting_path: str,
    location_path: str,
    target: str,
    provider: str,
    model: str,
    resolution: int = 6,
    rebuild: bool = False,
    least: Mapping[str, float] | None = None,
) -> Report:
    """Materialise lookups, build a new version of the feature table, check it, then publish it.

    Checks run on what was written. A version that fails is never published and readers of target, by
    read_published(), go on seeing the former one; one that passes is there as a whole at once.
    Incidents are read by the guards of their ids, for what they ask for, and for their rows.
    """
    guard_identities(incidents)
    spatial.validate_boundaries(calendar, boundaries)
    with_cells = incidents if "weather_query_cell_id" in incidents.columns else with_cell(incidents, resolution=resolution)
    asked = written(asked_for(with_cells), "asked-for")
    mapping = spatial.materialize_location_map(spark, located_events(asked, calendar), boundaries, location_path, rebuild=rebuild)
    lighting.materialize_lighting(spark, asked, lighting_path, rebuild=rebuild)
    rows = feature_rows(with_cells, calendar=calendar, location_map=mapping, census=census, weather=weather, lighting_table=spark.read.parquet(lighting_path), provider=provider, model=model, resolution=resolution, asked=asked)
    version = fresh_version(target)
    rows.write.parquet(version)
    source_count = asked.agg(F.coalesce(F.sum("incidents"), F.lit(0))).first()[0]
    report = validate_features(spark.read.parquet(version), source_count=source_count, least=least)
    publish(SparkStore(spark), version, target)
    discard(asked)
    return report


def count_panel(events: DataFrame, *, size: str, validate_from: str, test_from: str, at: str = "occurred_at", cell: str = "weather_query_cell_id") -> DataFrame:
    """Events per cell and window, zero where a cell has none, split by time into train, validation
    and test. Windows run from the first event of all cells to the last."""
    events = events.filter(F.col(at).isNotNull() & F.col(cell).isNotNull())
    counted = events.groupBy(F.col(cell).alias(cell), F.window(F.col(at).cast("timestamp"), size).start.alias("window_start")).agg(F.count(F.lit(1)).alias("event_count"))
    span = counted.agg(F.min("window_start").alias("first"), F.max("window_start").alias("last")).first()
    if span["first"] is None:
        return counted.withColumn("split", F.lit(None).cast("string"))
    every = F.sequence(F.lit(span["first"]), F.lit(span["last"]), F.expr(f"interval {size}"))
    grid = counted.select(cell).distinct().withColumn("window_start", F.explode(every))
    filled = grid.join(counted, [cell, "window_start"], "left").withColumn("event_count", F.coalesce("event_count", F.lit(0).cast("long")))
    day = F.to_date("window_start")
    part = F.when(day < F.lit(validate_from).cast("date"), "train").when(day < F.lit(test_from).cast("date"), "validation").otherwise("test")
    return filled.withColumn("split", part)
