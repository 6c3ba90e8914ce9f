"""Order-dependent work per key that no popular key can pile up in one task.

Each key's rows are cut into buckets of time. A bucket is one unit of work; what it needs from the
buckets before it is a summary, one row per key and bucket, carried over in a second, small pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def micros(at: Column | str) -> Column:
    """A time as microseconds; a time without zone counts as one of the session's."""
    return F.unix_micros((F.col(at) if isinstance(at, str) else at).cast("timestamp"))


def bucket(at: Column | str, cut: str) -> Column:
    """The number of the bucket of length cut, an interval of days or less, that a time lies in."""
    size = F.expr(f"unix_micros(timestamp_seconds(0) + interval {cut})")
    return F.floor(micros(at) / size).cast("long")


def _earlier(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)


def carried(rows: DataFrame, keys: Sequence[str], summaries: Mapping[str, Column]) -> DataFrame:
    """(keys, __bucket, names of summaries): for every bucket with rows, the last summary of earlier
    buckets that is not null."""
    per_bucket = rows.groupBy(*keys, "__bucket").agg(*(s.alias(n) for n, s in summaries.items()))
    return per_bucket.withColumns({n: F.last(n, ignorenulls=True).over(_earlier(keys)) for n in summaries})


def summed_before(rows: DataFrame, keys: Sequence[str], amounts: Mapping[str, Column]) -> DataFrame:
    """(keys, __bucket, names of amounts): for every bucket with rows, the sum over earlier buckets."""
    per_bucket = rows.groupBy(*keys, "__bucket").agg(*(F.sum(a).alias(n) for n, a in amounts.items()))
    return per_bucket.withColumns({n: F.coalesce(F.sum(n).over(_earlier(keys)), F.lit(0)) for n in amounts})
