"""Which cell-years of weather have to be requested."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions.grid import check_resolution, with_cell, with_center

#: Fixed values of requests.
PROVIDER, TIMEZONE, CELL_SELECTION = "open_meteo", "GMT", "nearest"
MODEL_STARTS = {"era5": dt.date(1940, 1, 1), "era5_land": dt.date(1950, 1, 1)}
AVAILABILITY_LAG_DAYS = 7
MANIFEST_COLUMNS = ("request_id", "provider", "model", "weather_query_cell_id", "h3_resolution", "query_latitude", "query_longitude", "start_date", "end_date", "timezone", "cell_selection", "hourly_variables", "event_count")


def request_manifest(events: DataFrame, *, model: str, hourly_variables: Iterable[str], resolution: int = 6, cutoff: dt.date | None = None) -> DataFrame:
    """One request per cell and year with events, clipped to what is available by cutoff.

    Events count if their location is valid and their day lies between the model's start and cutoff
    (a week ago, if not given). The request id depends on all that is asked for, on nothing else.
    """
    model = model.strip().lower()
    if model not in MODEL_STARTS:
        raise ValueError(f"unknown model {model!r}; known: {', '.join(sorted(MODEL_STARTS))}")
    check_resolution(resolution)
    variables = sorted({v.strip() for v in hourly_variables} - {""})
    if not variables:
        raise ValueError("at least one hourly variable is needed")
    c.require_columns(events, ["latitude", "longitude", "occurred_at"], context="request manifest")
    cutoff = cutoff or dt.date.today() - dt.timedelta(days=AVAILABILITY_LAG_DAYS)
    day = F.to_date("occurred_at")
    located = events.select(F.col("latitude").cast("double"), F.col("longitude").cast("double"), F.col("occurred_at").cast("timestamp"))
    usable = located.filter(c.valid_location() & day.between(F.lit(MODEL_STARTS[model]), F.lit(cutoff)))
    counted = with_cell(usable, resolution=resolution).groupBy("weather_query_cell_id", F.year("occurred_at").alias("year")).agg(F.count(F.lit(1)).alias("event_count"))
    asked = with_center(counted).withColumns(
        {
            "provider": F.lit(PROVIDER),
            "model": F.lit(model),
            "h3_resolution": F.lit(resolution),
            "start_date": F.make_date("year", F.lit(1), F.lit(1)),
            "end_date": F.least(F.make_date("year", F.lit(12), F.lit(31)), F.lit(cutoff)),
            "timezone": F.lit(TIMEZONE),
            "cell_selection": F.lit(CELL_SELECTION),
            "hourly_variables": F.array(*map(F.lit, variables)),
        }
    )
    parts = ["provider", "model", "weather_query_cell_id", "start_date", "end_date", F.concat_ws(",", "hourly_variables"), "timezone", "cell_selection", "h3_resolution"]
    named = asked.filter("start_date <= end_date").withColumn("request_id", F.sha2(F.concat_ws("|", *((F.col(p) if isinstance(p, str) else p).cast("string") for p in parts)), 256))
    return named.select(*MANIFEST_COLUMNS)


def pending_requests(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Requests whose response has not landed."""
    return manifest.join(landed.select("request_id"), "request_id", "left_anti")


def manifest_checks() -> dict[str, Column]:
    """Row predicates for a manifest, for one-pass checks or a valid/invalid split."""
    variables = F.col("hourly_variables")
    return {
        "request_id_not_empty": F.length(F.trim("request_id")) > 0,
        "provider_known": F.col("provider") == PROVIDER,
        "model_known": F.col("model").isin(*MODEL_STARTS),
        "resolution_range": F.col("h3_resolution").between(0, 15),
        "location_valid": c.valid_location("query_latitude", "query_longitude"),
        "dates_in_order": F.col("start_date") <= F.col("end_date"),
        "timezone_not_empty": F.length(F.trim("timezone")) > 0,
        "cell_selection_known": F.col("cell_selection").isin("land", "sea", "nearest"),
        "variables_not_empty": (F.size(variables) > 0) & F.forall(variables, lambda v: F.length(F.trim(v)) > 0),
        "variables_unique": F.size(F.array_distinct(variables)) == F.size(variables),
    }
