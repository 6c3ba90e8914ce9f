"""Tract estimates: rename, clear sentinels, cast, bound, and rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from .quality import split_valid

#: Fixed names of survey variables; each has an estimate (e) and a margin of error (m).
VARIABLES = {
    "b01003_001": "population",
    "b01002_001": "median_age",
    "b19013_001": "median_household_income",
    "b17001_001": "poverty_universe",
    "b17001_002": "population_below_poverty",
    "b23025_003": "civilian_labor_force",
    "b23025_005": "unemployed_population",
    "b25001_001": "housing_units",
    "b25002_002": "occupied_housing_units",
    "b25002_003": "vacant_housing_units",
    "b25003_001": "occupied_units_tenure_universe",
    "b25003_003": "renter_occupied_units",
    "b08201_001": "households_vehicle_universe",
    "b08201_002": "households_no_vehicle",
}
RENAMES = {f"{code}{kind}": name + end for code, name in VARIABLES.items() for kind, end in (("e", ""), ("m", "_moe"))}
#: Medians are doubles, all else counts.
DOUBLES = tuple(n for n in RENAMES.values() if n.startswith("median"))
COUNTS = tuple(n for n in RENAMES.values() if n not in DOUBLES)
#: Fixed codes that stand for a missing value.
SENTINELS = ("-666666666", "-888888888", "-999999999", "-222222222", "-333333333", "-555555555")
RATES = {
    "poverty_rate": ("population_below_poverty", "poverty_universe"),
    "unemployment_rate": ("unemployed_population", "civilian_labor_force"),
    "vacancy_rate": ("vacant_housing_units", "housing_units"),
    "renter_occupied_rate": ("renter_occupied_units", "occupied_units_tenure_universe"),
    "no_vehicle_rate": ("households_no_vehicle", "households_vehicle_universe"),
}


def rename_variables(df: DataFrame) -> DataFrame:
    c.require_columns(df, RENAMES, context="census")
    return df.withColumnsRenamed(RENAMES)


def clear_sentinels(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.when(~F.trim(F.col(n).cast("string")).isin(*SENTINELS), F.col(n)) for n in RENAMES.values()})


def cast_variables(df: DataFrame) -> DataFrame:
    return df.withColumns({**{n: c.safe_cast(n, "bigint") for n in COUNTS}, **{n: c.safe_cast(n, "double") for n in DOUBLES}})


def bound_variables(df: DataFrame) -> DataFrame:
    """Negative numbers and ages over 120 become null."""
    not_negative = {n: F.when(F.col(n) >= 0, F.col(n)) for n in (*COUNTS, *DOUBLES)}
    return df.withColumns({**not_negative, "median_age": F.when(F.col("median_age").between(0.0, 120.0), F.col("median_age"))})


def census_tracts(df: DataFrame) -> DataFrame:
    """All steps: 39 columns, 5 rates and the time of processing; rows without a key are left out."""
    typed = bound_variables(cast_variables(clear_sentinels(rename_variables(df))))
    years = ("acs_vintage", "period_start_year", "period_end_year")
    rows = typed.select(
        "geoid",
        F.col("name").alias("geography_name"),
        F.col("state").alias("state_fips"),
        F.col("county").alias("county_fips"),
        F.col("tract").alias("tract_code"),
        *(c.safe_cast(y, "int").alias(y) for y in years),
        "geography_type",
        *RENAMES.values(),
        "source_file",
        F.col("ingested_at").alias("bronze_ingested_at"),
    )
    rates = {rate: c.safe_rate(a, b) for rate, (a, b) in RATES.items()}
    return rows.withColumns({**rates, "silver_processed_at": F.current_timestamp()}).filter(c.all_not_null(["geoid", "acs_vintage"]))


def payload_records(df: DataFrame, *, payload: str = "payload", vintage: str = "acs_vintage") -> tuple[DataFrame, DataFrame]:
    """(records, invalid) of landed payloads: JSON arrays, the first row the header.

    A record has the payload's fields as a map, geoid (state, county and tract together) and the
    five-year period that ends with the vintage. Rows as wide as the header are records; other rows,
    payloads that do not parse, and those whose header repeats a name are invalid.
    """
    table = df.withColumn("__table", F.from_json(payload, "array<array<string>>"))
    table = table.withColumn("__header", F.try_element_at("__table", F.lit(1)))
    body = F.expr("slice(__table, 2, greatest(size(__table) - 1, 0))")
    rows = table.select("*", F.explode_outer(body).alias("__row"))
    valid, invalid = split_valid(rows, {"parses": F.col("__header").isNotNull(), "as_wide_as_header": F.size("__row") == F.size("__header"), "names_once": F.size(F.array_distinct("__header")) == F.size("__header")})
    valid = valid.withColumn("record", F.map_from_arrays("__header", "__row"))
    part = lambda name: F.try_element_at("record", F.lit(name))
    valid = valid.withColumns({"geoid": F.concat(part("state"), part("county"), part("tract")), "period_start_year": (F.col(vintage) - 4).cast("int"), "period_end_year": F.col(vintage).cast("int")})
    return valid.drop("__table", "__header", "__row", payload), invalid.drop("__table", "__header")
