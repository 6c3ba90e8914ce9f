"""Three sources on one canonical contract, with a stable id."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c

#: Fixed contract: names, order and types.
CONTRACT = {
    "source_city": "string",
    "source_record_id": "string",
    "source_incident_id": "string",
    "offense_code": "string",
    "offense_name": "string",
    "offense_description": "string",
    "occurred_at": "timestamp",
    "reported_at": "timestamp",
    "updated_at": "timestamp",
    "offense_count": "bigint",
    "address": "string",
    "city": "string",
    "state": "string",
    "postal_code": "string",
    "beat": "string",
    "premise_type": "string",
    "latitude": "double",
    "longitude": "double",
    "alternate_latitude": "double",
    "alternate_longitude": "double",
    "source_x_coordinate": "double",
    "source_y_coordinate": "double",
    "source_file": "string",
    "source_row_hash": "string",
}


def assert_contract(df: DataFrame) -> DataFrame:
    """df itself, if names, order and types are the contract's; nullability is free."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = list(CONTRACT.items())
    if len(got) != len(want):
        raise ValueError(f"{len(got)} columns instead of {len(want)}")
    wrong = [f"{i}: {g} instead of {w}" for i, (g, w) in enumerate(zip(got, want, strict=True)) if g != w]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df


def on_contract(df: DataFrame, mapping: Mapping[str, Column | str], *, source: str, needs: tuple[str, ...] = ()) -> DataFrame:
    """Project df as a mapping says: a name is a column, safely cast; what is not mapped is null."""
    named = {x for x in mapping.values() if isinstance(x, str)}
    c.require_columns(df, [*named, *needs, "source_file", "source_row_hash"], context=source)
    full = {"source_city": F.lit(source), "source_file": "source_file", "source_row_hash": "source_row_hash", **mapping}
    return df.select(*(c.safe_cast(full[name], kind).alias(name) if name in full else c.null_of(kind).alias(name) for name, kind in CONTRACT.items()))


def _first(*names: str) -> Column:
    return F.coalesce(*(F.col(n).cast("string") for n in names))


def dallas(df: DataFrame) -> DataFrame:
    needs = ("nibrs_crime", "ucr_offense_name", "type_of_incident", "ucr_offense_description", "date1_of_occurrence", "time1_of_occurrence", "date_of_report", "update_date", "location1")
    c.require_columns(df, needs, context="dallas")
    mapping = {
        "source_record_id": "service_number_id",
        "source_incident_id": "incident_number_w_year",
        "offense_code": "nibrs_code",
        "offense_name": _first("nibrs_crime", "ucr_offense_name", "type_of_incident"),
        "offense_description": _first("ucr_offense_description", "type_of_incident"),
        "occurred_at": c.date_and_time("date1_of_occurrence", "time1_of_occurrence"),
        "reported_at": c.parsed_timestamp("date_of_report"),
        "updated_at": c.parsed_timestamp("update_date"),
        "offense_count": F.lit(1),
        "address": "incident_address",
        "city": "city",
        "state": "state",
        "postal_code": "zip_code",
        "beat": "beat",
        "premise_type": "type_location",
        "latitude": c.coordinate("location1", 1),
        "longitude": c.coordinate("location1", 2),
        "source_x_coordinate": "x_coordinate",
        "source_y_coordinate": "y_cordinate",
    }
    return assert_contract(on_contract(df, mapping, source="dallas", needs=needs))


def fort_worth(df: DataFrame) -> DataFrame:
    needs = ("case_no_offense", "objectid", "from_date", "reported_date", "lastupdated", "address", "block_address")
    c.require_columns(df, needs, context="fort_worth")
    mapping = {
        "source_record_id": _first("case_no_offense", "objectid"),
        "source_incident_id": "case_no",
        "offense_code": "offense",
        "offense_name": "nature_of_call",
        "offense_description": "offense_desc",
        "occurred_at": c.from_millis("from_date"),
        "reported_at": c.from_millis("reported_date"),
        "updated_at": c.from_millis("lastupdated"),
        "offense_count": F.lit(1),
        "address": _first("address", "block_address"),
        "city": "city",
        "state": "state",
        "beat": "beat",
        "premise_type": "locationtypedescription",
        "latitude": "latitude",
        "longitude": "longitude",
        "alternate_latitude": "alternate_latitude",
        "alternate_longitude": "alternate_longitude",
        "source_x_coordinate": "x_coordinate",
        "source_y_coordinate": "y_coordinate",
    }
    return assert_contract(on_contract(df, mapping, source="fort_worth", needs=needs))


def houston(df: DataFrame) -> DataFrame:
    needs = ("rmsoccurrencedate", "rmsoccurrencehour", "streetno", "streetname", "streettype", "suffix")
    c.require_columns(df, needs, context="houston")
    mapping = {
        "source_record_id": "source_row_hash",
        "source_incident_id": "incident",
        "offense_code": "nibrsclass",
        "offense_name": "nibrsdescription",
        "offense_description": "nibrsdescription",
        "occurred_at": c.date_and_hour("rmsoccurrencedate", "rmsoccurrencehour"),
        "offense_count": "offensecount",
        "address": c.joined_words("streetno", "streetname", "streettype", "suffix"),
        "city": "city",
        "state": F.lit("TX"),
        "postal_code": "zipcode",
        "beat": "beat",
        "premise_type": "premise",
        "latitude": "maplatitude",
        "longitude": "maplongitude",
    }
    return assert_contract(on_contract(df, mapping, source="houston", needs=needs))


TO_CANONICAL = {"dallas": dallas, "fort_worth": fort_worth, "houston": houston}


def union_incidents(raw: Mapping[str, DataFrame]) -> DataFrame:
    """The sources' incidents in one table; further columns of a source are left out."""
    return assert_contract(reduce(DataFrame.unionByName, (TO_CANONICAL[name](df) for name, df in sorted(raw.items()))))


def with_incident_id(df: DataFrame, output: str = "incident_id") -> DataFrame:
    """Add the SHA-256 of a source's natural key, its city in front, parts joined by ||.

    Dallas: incident, record and code. Fort Worth: record. Houston, other cities, and rows that lack
    a part of their key: row hash. Null without that too. Cities and parts are trimmed.
    """
    c.require_columns(df, ["source_city", "source_incident_id", "source_record_id", "offense_code", "source_row_hash"], context="incident id")
    city = F.lower(F.trim("source_city"))
    natural = {"dallas": ["source_incident_id", "source_record_id", "offense_code"], "fort_worth": ["source_record_id"]}
    by_source = [F.when((city == name) & c.all_not_null(parts), F.concat_ws("||", city, *map(F.trim, parts))) for name, parts in natural.items()]
    by_hash = F.when(F.col("source_row_hash").isNotNull(), F.concat_ws("||", city, "source_row_hash"))
    return df.withColumn(output, F.sha2(F.coalesce(*by_source, by_hash), 256))


def guard_ids(df: DataFrame, key: str = "incident_id") -> DataFrame:
    """df itself, once every row has an id; else an error with up to 20 examples."""
    shown = df.filter(F.col(key).isNull()).select("source_city", "source_incident_id", "source_record_id", "offense_code", "source_row_hash").limit(20).collect()
    if shown:
        raise ValueError(f"rows without {key}: {[r.asDict() for r in shown]}")
    return df
