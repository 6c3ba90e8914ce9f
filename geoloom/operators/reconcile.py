"""What changed between two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import require_columns
from .dedup import one_row_per_key


def reconcile(before: DataFrame, after: DataFrame, keys: Sequence[str], *, unchanged: bool = False) -> DataFrame:
    """One row per key that was added, removed or changed: keys, change, changed_columns.

    Keys are compared null-safely: a null key is a key like others. A key that occurs twice in a
    snapshot is an error of the query. changed_columns names, in order of name, the shared columns
    that differ, null against null being equal, and for a change of schema the columns that one side
    lacks, where the other's value is not null. With unchanged, equal rows are listed too.

    Each side is reduced to its keys and one hash per column before it is shuffled.
    """
    require_columns(before, keys, context="before")
    require_columns(after, keys, context="after")
    names = sorted((set(before.columns) | set(after.columns)) - set(keys))

    def hashed(df: DataFrame, side: str) -> DataFrame:
        codes = [F.when(F.col(c).isNotNull(), F.xxhash64(F.to_json(F.struct(F.col(c))))) if c in df.columns else F.lit(None).cast("long") for c in names]
        rows = df.select(*(F.col(k).alias(f"{side}_{k}") for k in keys), F.array(*codes).cast("array<bigint>").alias(f"{side}_codes"))
        return one_row_per_key(rows, [f"{side}_{k}" for k in keys], name=side)

    both = hashed(before, "before").join(hashed(after, "after"), [F.col(f"before_{k}").eqNullSafe(F.col(f"after_{k}")) for k in keys], "full_outer")
    differ = F.filter(F.array(*(F.when(~F.get("before_codes", F.lit(i)).eqNullSafe(F.get("after_codes", F.lit(i))), F.lit(c)) for i, c in enumerate(names))).cast("array<string>"), lambda x: x.isNotNull())
    change = F.when(F.col("before_codes").isNull(), "added").when(F.col("after_codes").isNull(), "removed").when(F.size(differ) > 0, "changed").otherwise("unchanged")
    out = both.select(*(F.when(F.col("after_codes").isNull(), F.col(f"before_{k}")).otherwise(F.col(f"after_{k}")).alias(k) for k in keys), change.alias("change"), F.when(change == "changed", differ).otherwise(F.array().cast("array<string>")).alias("changed_columns"))
    return out if unchanged else out.filter("change <> 'unchanged'")


def multiset_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows without a key: every distinct row whose count differs, with how many more there are after.

    Both sides have the same columns. The counts add up within each task before they are shuffled.
    """
    require_columns(after, before.columns, context="after")
    signed = before.withColumn("row_difference", F.lit(-1).cast("long")).unionByName(after.select(*before.columns).withColumn("row_difference", F.lit(1).cast("long")))
    return signed.groupBy(*before.columns).agg(F.sum("row_difference").alias("row_difference")).filter("row_difference <> 0")
