"""Deterministic deduplication, fingerprints and duplicate-key guards."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import all_not_null
from ..functions.hashing import content_hash


def one_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str], *, tie_excluded: Iterable[str] = ()) -> DataFrame:
    """Keep the row of each key that is newest, column by column; nulls count as oldest.

    Ties go by a fingerprint of the whole row but for tie_excluded, then by the columns named after
    "fingerprint" in newest, so the result does not depend on the order of rows.
    """
    marked = df.withColumn("__fingerprint", content_hash(df, tie_excluded))
    order = [F.col("__fingerprint" if c == "fingerprint" else c).desc_nulls_last() for c in newest]
    ranked = marked.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("__rank = 1").drop("__rank", "__fingerprint")


def latest_incidents(df: DataFrame, key: str = "incident_id") -> DataFrame:
    """One row per incident id: the latest update, then report, then occurrence."""
    return one_per_key(df, [key], ["updated_at", "reported_at", "occurred_at", "source_row_hash", "fingerprint", "source_file"], tie_excluded=["source_file"])


def latest_weather(df: DataFrame, keys: Sequence[str] = ("provider", "model", "weather_query_cell_id", "weather_timestamp")) -> DataFrame:
    """One row per weather key: the newest ingest."""
    return one_per_key(df, keys, ["bronze_ingested_at", "fingerprint", "source_row_hash", "source_file"], tie_excluded=["bronze_ingested_at", "silver_processed_at"])


def latest_census(df: DataFrame) -> DataFrame:
    """One row per tract and vintage: the newest ingest."""
    return one_per_key(df, ["geoid", "acs_vintage"], ["bronze_ingested_at", "fingerprint", "source_file"], tie_excluded=["bronze_ingested_at", "silver_processed_at"])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def guard_unique(df: DataFrame, keys: Sequence[str], *, name: str) -> DataFrame:
    """df itself, once no key occurs twice; else an error with the 20 most frequent."""
    found = duplicate_keys(df, keys).orderBy(F.desc("row_count"), *keys).limit(20).collect()
    if found:
        raise ValueError(f"{name}: keys {', '.join(keys)} are not unique: {[r.asDict() for r in found]}")
    return df


def one_row_per_key(lookup: DataFrame, keys: Sequence[str], *, name: str) -> DataFrame:
    """A lookup with each key once; a key that occurs twice is an error when the rows are read.

    The check is part of the aggregation that a join on the keys would shuffle for anyway, so nothing
    runs twice and nothing runs before the result is asked for.
    """
    others = [c for c in lookup.columns if c not in keys]
    per_key = lookup.groupBy(*keys).agg(F.first(F.struct(*others)).alias("__row"), F.count(F.lit(1)).alias("__n"))
    several = F.raise_error(F.concat(F.lit(f"{name}: keys are not unique: "), F.to_json(F.struct(*keys)), F.lit(" occurs "), F.col("__n").cast("string"), F.lit(" times"))).cast("boolean")
    return per_key.filter(F.when(F.col("__n") == 1, F.lit(True)).otherwise(several)).select(*keys, *(F.col("__row")[c].alias(c) for c in others))


def guard_identities(df: DataFrame, key: str = "incident_id") -> DataFrame:
    """df itself, once every id is there and occurs once."""
    lacking = df.filter(~all_not_null([key])).limit(20).collect()
    if lacking:
        raise ValueError(f"rows without {key}: {[r.asDict() for r in lacking]}")
    return guard_unique(df, [key], name="incidents")
