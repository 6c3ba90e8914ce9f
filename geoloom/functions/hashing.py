"""Content hashes that don't depend on column order or file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns that say how a row came in, not what it says.
OPERATIONAL = frozenset({"source_file", "source_row_hash", "source_system", "ingested_at", "_rescued_data"})


def content_hash(df: DataFrame, excluded: Iterable[str] = OPERATIONAL) -> Column:
    """SHA-256 of the JSON of all other columns in order of name, nulls included.

    Another column changes the hash even if it is null.
    """
    payload = sorted(set(df.columns) - set(excluded))
    if not payload:
        raise ValueError("no payload columns to hash")
    return F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in payload)), {"ignoreNullFields": "false"}), 256)


def with_ingestion_metadata(df: DataFrame, system: str) -> DataFrame:
    """Add source_row_hash, source_system and ingested_at."""
    return df.withColumns({"source_row_hash": content_hash(df), "source_system": F.lit(system), "ingested_at": F.current_timestamp()})
