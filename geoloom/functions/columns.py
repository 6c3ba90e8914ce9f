"""Safe parsing, typed nulls, predicates and time grains as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fractions of seconds with seven, six and no digits.
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss.SSSSSSS", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss")
#: "... (32.877, -96.758)"
COORDINATES = r"\(\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*\)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def require_columns(df: DataFrame, names: Iterable[str], *, context: str) -> None:
    """An analysis-time error that lists what df lacks, in order of name."""
    lacking = sorted(set(names) - set(df.columns))
    if lacking:
        raise ValueError(f"{context}: missing columns {', '.join(lacking)}")


def null_of(kind: str) -> Column:
    return F.lit(None).cast(kind)


def safe_cast(column: Column | str, kind: str) -> Column:
    """Null instead of an error where the value does not parse."""
    return _col(column).try_cast(kind)


def from_millis(column: Column | str) -> Column:
    """Epoch milliseconds, as number or text, as a timestamp; negative and malformed give null."""
    ms = safe_cast(column, "bigint")
    return F.when(ms >= 0, F.timestamp_millis(ms))


def joined_words(*parts: Column | str) -> Column:
    """The parts that are not null, with one space between them, trimmed; never null."""
    return F.trim(F.regexp_replace(F.concat_ws(" ", *map(_col, parts)), " +", " "))


def parsed_timestamp(column: Column | str, formats: Iterable[str] = TIMESTAMP_FORMATS) -> Column:
    """The first format that fits."""
    return F.coalesce(*(F.try_to_timestamp(_col(column), F.lit(f)) for f in formats))


def date_and_time(date: Column | str, time: Column | str) -> Column:
    """The day of a timestamp text with the clock time of another text."""
    return F.try_to_timestamp(F.concat_ws(" ", F.substring(_col(date), 1, 10), F.when(_col(date).isNotNull(), _col(time))), F.lit("yyyy-MM-dd HH:mm"))


def date_and_hour(date: Column | str, hour: Column | str) -> Column:
    """M/d/yyyy with an hour number of one or two digits; hour 24 gives null."""
    return F.try_to_timestamp(F.concat(_col(date), F.lit(" "), F.lpad(_col(hour).cast("string"), 2, "0")), F.lit("M/d/yyyy HH"))


def coordinate(column: Column | str, group: int) -> Column:
    """Latitude (group 1) or longitude (group 2) from free text that ends in "(lat, lon)"."""
    return safe_cast(F.nullif(F.regexp_extract(_col(column), COORDINATES, group), F.lit("")), "double")


def valid_location(latitude: Column | str = "latitude", longitude: Column | str = "longitude") -> Column:
    """True only for a pair of finite numbers on the globe; never null."""
    lat, lon = _col(latitude), _col(longitude)
    return F.coalesce(~F.isnan(lat) & ~F.isnan(lon) & lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0), F.lit(False))


def null_or_valid_location(latitude: Column | str = "latitude", longitude: Column | str = "longitude") -> Column:
    lat, lon = _col(latitude), _col(longitude)
    return (lat.isNull() & lon.isNull()) | valid_location(lat, lon)


def on_the_hour(column: Column | str) -> Column:
    return _col(column) == F.date_trunc("hour", _col(column))


def has_source_identity(system: str = "source_city", row_hash: str = "source_row_hash") -> Column:
    return F.col(system).isNotNull() & F.col(row_hash).isNotNull()


def has_time(column: str = "occurred_at") -> Column:
    return F.col(column).isNotNull()


def all_not_null(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def safe_rate(numerator: Column | str, denominator: Column | str) -> Column:
    """Null unless the denominator is positive."""
    return F.when(_col(denominator) > 0, _col(numerator) / _col(denominator))


def sorted_place(value: Column, cuts: Sequence[Any], first: int = 0) -> Column:
    """How many of the sorted cuts are at or below the value: a tree of comparisons with literals."""
    if not cuts:
        return F.lit(first)
    half = len(cuts) // 2
    return F.when(value < F.lit(cuts[half]), sorted_place(value, cuts[:half], first)).when(value.isNotNull(), sorted_place(value, cuts[half + 1 :], first + half + 1))


def with_time_grains(df: DataFrame, at: str = "occurred_at") -> DataFrame:
    """Add the date and the hour of an event."""
    return df.withColumns({"occurred_date": F.to_date(at), "occurred_at_hour": F.date_trunc("hour", F.col(at))})
