"""Guarded left enrichment with match flags, lookups and coverage.

Joins are dealt evenly however popular a key is: see skew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import require_columns
from . import skew
from .dedup import one_row_per_key

CENSUS_ATTRIBUTES = ("geography_name", "population", "population_moe", "median_age", "median_age_moe", "median_household_income", "median_household_income_moe", "poverty_rate", "unemployment_rate", "vacancy_rate", "renter_occupied_rate", "no_vehicle_rate")


def enrich(df: DataFrame, lookup: DataFrame, on: Mapping[str, str], attributes: Mapping[str, str], *, flag: str | None, name: str, guard: bool = True, hot: Column | int | None = None) -> DataFrame:
    """Left join on equal columns (df column: lookup column), adding attributes under new names.

    With guard, a lookup key that occurs twice is an error of the query, so rows are never multiplied. flag tells
    whether a row found its match, also where all attributes are null. Null keys match nothing.

    Keys that many rows of df share are dealt over many tasks, and so are rows with a null key. hot
    names those keys as skew.hot_slots() does, or is a number of pieces for every key, which copies
    the lookup as often; without it keys are counted in df, which reads df's key columns once more.
    After other joins it is better to count keys in the table that they come from. Whether the lookup
    is broadcast is left to Spark, which knows its size.
    """
    require_columns(df, on, context=name)
    require_columns(lookup, [*on.values(), *attributes], context=f"{name} lookup")
    keys = {left: f"__key_{i}" for i, left in enumerate(on)}
    slim = lookup.select(*(F.col(right).alias(keys[left]) for left, right in on.items()), *(F.col(a).alias(b) for a, b in attributes.items()), F.lit(True).alias("__found"))
    if guard:
        slim = one_row_per_key(slim, list(keys.values()), name=name)
    hot = skew.hot_slots(df, list(on)) if hot is None else hot
    slim = skew.copied(slim, list(keys.values()), hot, [df.schema[k].dataType for k in on]).withColumnRenamed(skew.PIECE, "__copy")
    condition = [*(F.col(left) == F.col(k) for left, k in keys.items()), F.col(skew.PIECE) == F.col("__copy")]
    joined = skew.dealt(df, list(on), hot).join(slim, condition, "left").drop(*keys.values(), skew.PIECE, "__copy")
    return joined.drop("__found") if flag is None else joined.withColumn(flag, F.coalesce("__found", F.lit(False))).drop("__found")


def attach_tracts(df: DataFrame, mapping: DataFrame, *, hot: Column | int | None = None) -> DataFrame:
    return enrich(df, mapping, {"tiger_line_year": "tiger_line_year", "latitude": "latitude", "longitude": "longitude"}, {"tract_geoid": "tract_geoid"}, flag=None, name="location map", hot=hot)


def attach_socioeconomic(df: DataFrame, census: DataFrame, *, hot: Column | int | None = None) -> DataFrame:
    return enrich(df, census, {"tract_geoid": "geoid", "selected_acs_vintage": "acs_vintage"}, {a: a for a in CENSUS_ATTRIBUTES}, flag="socioeconomic_match_found", name="census", hot=hot)


def weather_lookup(events: DataFrame, weather: DataFrame, *, provider: str, model: str, resolution: int, days_before: int = 0) -> DataFrame:
    """Hours of one provider, model and resolution that events can ask for, from days_before the first.

    The events' first and last day are one subquery, which prunes partitions when the query runs;
    their cells reduce the rest by a semi-join. Events without any date are an error of the query.
    """
    dateless = F.raise_error(F.lit("weather lookup: no event has a date")).cast("date")
    days = events.agg(F.struct(F.coalesce(F.min("occurred_date"), dateless).alias("first"), F.max("occurred_date").alias("last"))).scalar()
    first, last = F.date_sub(days["first"], days_before), days["last"]
    wanted = (F.col("provider") == provider) & (F.col("model") == model) & (F.col("h3_resolution") == resolution) & F.col("weather_date").between(first, last)
    columns = ("weather_query_cell_id", "weather_timestamp", "provider", "model", "h3_resolution", "request_id", "source_row_hash", "temperature_2m_c", "grid_elevation")
    cells = events.select("weather_query_cell_id").filter("weather_query_cell_id IS NOT NULL").distinct()
    return weather.filter(wanted).select(*columns).join(cells, "weather_query_cell_id", "left_semi")


def attach_weather(df: DataFrame, lookup: DataFrame, *, hot: Column | int | None = None) -> DataFrame:
    names = {"provider": "weather_provider", "model": "weather_model", "h3_resolution": "weather_h3_resolution", "request_id": "weather_request_id", "source_row_hash": "weather_source_row_hash", "temperature_2m_c": "temperature_2m_c", "grid_elevation": "grid_elevation"}
    return enrich(df, lookup, {"weather_query_cell_id": "weather_query_cell_id", "occurred_at_hour": "weather_timestamp"}, names, flag="weather_match_found", name="weather", hot=hot)


def lighting_lookup(lighting: DataFrame, *, version: str) -> DataFrame:
    columns = ("weather_query_cell_id", "solar_timestamp_hour", "lighting_definition_version", "solar_elevation_deg", "apparent_solar_elevation_deg", "solar_zenith_deg", "solar_azimuth_deg", "lighting_condition", "is_daylight", "solar_model_version")
    return lighting.filter(F.col("lighting_definition_version") == version).select(*columns)


def attach_lighting(df: DataFrame, lookup: DataFrame, *, hot: Column | int | None = None) -> DataFrame:
    same = ("lighting_definition_version", "solar_elevation_deg", "apparent_solar_elevation_deg", "solar_zenith_deg", "solar_azimuth_deg", "lighting_condition", "is_daylight")
    return enrich(df, lookup, {"weather_query_cell_id": "weather_query_cell_id", "occurred_at_hour": "solar_timestamp_hour"}, {**{n: n for n in same}, "solar_model_version": "lighting_solar_model_version"}, flag="lighting_match_found", name="lighting", hot=hot)


def coverage(df: DataFrame, rates: Sequence[str] = ("tract", "socioeconomic", "weather", "lighting")) -> DataFrame:
    """One row of counts and rates (8 decimals, null for an empty table), from one pass."""
    matched = {
        "selected_vintage": F.col("selected_acs_vintage").isNotNull(),
        "tract": F.col("tract_geoid").isNotNull(),
        "socioeconomic": F.col("socioeconomic_match_found"),
        "median_household_income": F.col("median_household_income").isNotNull(),
        "weather": F.col("weather_match_found"),
        "temperature": F.col("temperature_2m_c").isNotNull(),
        "lighting": F.col("lighting_match_found"),
    }
    counts = [F.count_if(p).cast("long").alias(f"{n}_count") for n, p in matched.items()]
    shares = [F.round(F.avg(matched[n].cast("double")), 8).alias(f"{n}_rate") for n in rates]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *counts, *shares)
