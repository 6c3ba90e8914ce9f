"""Tables laid out so that a filter on any of several columns skips most files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import sorted_place

#: Most bits of a column's share of a key: 255 cuts, which become literals.
MOST_BITS = 8


def _number(df: DataFrame, column: str) -> Column:
    """A column's values as numbers in the same order."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    raise ValueError(f"{column}: only numbers, dates and times can be interleaved, not {kind.simpleString()}")


def interleaved(places: Sequence[Column], bits: int) -> Column:
    """One number from the bits of several, the highest of each first, in turn."""
    key = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for place in places:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long"))
    return key


def with_z_key(df: DataFrame, columns: Sequence[str], *, bits: int = 6, output: str = "__z") -> DataFrame:
    """Add the place of each row on a Z-shaped curve through the columns' ranks.

    Each column is cut into 2**bits runs of about equally many rows, by quantiles found in one pass;
    the numbers of the runs are interleaved. Nulls, and NaN, go to the first and last run.
    """
    if not 1 <= bits <= MOST_BITS or len(columns) * bits > 62:
        raise ValueError(f"bits must be 1 to {MOST_BITS}, and at most 62 for all columns")
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*(F.percentile_approx(_number(df, c), shares, 10_000).alias(f"q{i}") for i, c in enumerate(columns))).first()
    # each place is a column of its own first: it is used once per bit
    placed = df.withColumns({f"__z{i}": F.coalesce(sorted_place(_number(df, c), sorted(set(found[i] or []))), F.lit(0)).cast("long") for i, c in enumerate(columns)})
    return placed.withColumn(output, interleaved([F.col(f"__z{i}") for i in range(len(columns))], bits)).drop(*(f"__z{i}" for i in range(len(columns))))


def write_z_ordered(df: DataFrame, path: str, columns: Sequence[str], *, files: int, bits: int = 6, mode: str = "overwrite") -> None:
    """Write df in about so many files, each a stretch of the curve, sorted by it inside.

    A run that holds more rows than a file is cut further by the columns themselves, so one popular
    value does not make one large file. Readers' filters on any of the columns meet narrow ranges in
    the files' statistics.
    """
    keyed = with_z_key(df, columns, bits=bits)
    keyed.repartitionByRange(files, "__z", *columns).sortWithinPartitions("__z", *columns).drop("__z").write.mode(mode).parquet(path)
