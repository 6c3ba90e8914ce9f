"""Archive responses with parallel hourly arrays as one row per hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as c
from .quality import split_valid

_REQUIRED = ("provider", "model", "request_id", "weather_query_cell_id", "h3_resolution", "query_latitude", "query_longitude", "grid_latitude", "grid_longitude", "grid_elevation", "hourly", "hourly_units", "timezone", "utc_offset_seconds", "source_file", "source_row_hash", "ingested_at")
_NUMBERS = {"weather_query_cell_id": "bigint", "h3_resolution": "int", "query_latitude": "double", "query_longitude": "double", "grid_latitude": "double", "grid_longitude": "double", "grid_elevation": "double", "utc_offset_seconds": "int"}
#: Fixed columns of the hourly table, in order.
HOURLY_COLUMNS = (
    "provider",
    "model",
    "request_id",
    "weather_query_cell_id",
    "h3_resolution",
    "query_latitude",
    "query_longitude",
    "grid_latitude",
    "grid_longitude",
    "grid_elevation",
    "weather_timestamp",
    "temperature_2m_c",
    "temperature_unit",
    "timezone",
    "utc_offset_seconds",
    "source_file",
    "source_row_hash",
    "bronze_ingested_at",
    "silver_processed_at",
    "weather_date",
)


def json_or_struct(df: DataFrame, column: str, schema: str) -> Column:
    """The column as that struct, from JSON text or from a struct with castable fields."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.from_json(column, schema)
    if not isinstance(kind, T.StructType):
        raise TypeError(f"{column} must be JSON text or a struct, not {kind.simpleString()}")
    return F.col(column)


def cast_elements(array: Column, kind: str) -> Column:
    """Each element safely cast: one that does not parse becomes null, the others stay."""
    return F.transform(array, lambda x: x.try_cast(kind))


def hourly_weather(df: DataFrame) -> DataFrame:
    """Explode responses, batch or stream, to hours.

    Responses whose arrays differ in length or are empty, or that do not parse, are left out, as are
    hours without a whole timestamp or with a null key. A temperature that is no number is null.
    """
    c.require_columns(df, _REQUIRED, context="weather")
    hourly = json_or_struct(df, "hourly", "time array<string>, temperature_2m array<string>")
    units = json_or_struct(df, "hourly_units", "time string, temperature_2m string")
    arrays = df.withColumns({"__time": cast_elements(hourly["time"], "string"), "__temperature": cast_elements(hourly["temperature_2m"], "double"), "__unit": units["temperature_2m"]})
    paired = arrays.filter((F.size("__time") > 0) & (F.size("__time") == F.size("__temperature")))
    hours = paired.withColumn("__hour", F.explode(F.arrays_zip("__time", "__temperature")))
    at = F.try_to_timestamp(F.col("__hour.__time"), F.lit("yyyy-MM-dd'T'HH:mm"))
    made = {
        **{n: c.safe_cast(n, k) for n, k in _NUMBERS.items()},
        "weather_timestamp": at,
        "temperature_2m_c": F.col("__hour.__temperature"),
        "temperature_unit": F.col("__unit"),
        "bronze_ingested_at": F.col("ingested_at"),
        "silver_processed_at": F.current_timestamp(),
        "weather_date": F.to_date(at),
    }
    rows = hours.select(*(made.get(n, F.col(n)).alias(n) for n in HOURLY_COLUMNS))
    return rows.filter(c.all_not_null(["provider", "model", "weather_query_cell_id", "weather_timestamp"]) & c.on_the_hour("weather_timestamp"))


def valid_responses(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) responses. Valid: no error flag, time not empty, and each requested variable
    an array as long as time. hourly is JSON text."""
    arrays = F.from_json("hourly", "map<string,array<string>>")
    size = F.size(F.element_at(arrays, "time"))
    checks = {"parses": arrays.isNotNull(), "has_time": size > 0, "has_variables": F.forall("hourly_variables", lambda v: F.size(F.try_element_at(arrays, v)) == size)}
    if "error" in df.columns:
        checks["no_error"] = ~F.coalesce(F.col("error").cast("boolean"), F.lit(False))
    return split_valid(df, checks)
