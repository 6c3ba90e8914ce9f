"""Equality joins that stay even when a few keys, or null, hold most of the rows.

Keys fall into a fixed number of slots by hash. A histogram of the left side's slots tells which
ones hold more than a task's share, and into how many pieces each is cut. Left rows of such a slot
are dealt over its pieces, right rows of it are copied to every piece, so that both sides meet on
the keys and the piece. Both sides are plain exchanges, which Spark may still split by size. Where
the right side is small whatever the left one is, a fixed number of pieces for all keys saves the
histogram.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Slots of the histogram.
SLOTS = 1 << 16
#: Pieces per share of a task, so that chance does not put several full pieces into one task.
PIECES_PER_TASK = 8
#: Pieces that rows without a key are dealt over; they match nothing.
NULL_PIECES = 1 << 20

PIECE = "__piece"


def slot(keys: Sequence[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(SLOTS)).cast("int")


def hot_slots(df: DataFrame, keys: Sequence[str], *, rows: str | None = None) -> Column:
    """Pieces of each hot slot as one map, which is a scalar subquery: it runs when rows are asked for.

    The counts add up within each task before they are shuffled, whatever the keys are. A row of df
    stands for as many as its column rows says, or for one. Rows with a null key don't count. A slot is hot beyond the share of one of spark.sql.shuffle.partitions tasks,
    so there are fewer hot slots than tasks; it gets PIECES_PER_TASK pieces for each share.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = df.select(*keys, (F.lit(1) if rows is None else F.col(rows)).alias("__rows")).na.drop(subset=list(keys))
    counted = given.groupBy(slot([F.col(k) for k in keys]).alias("slot")).agg(F.sum("__rows").alias("rows"))
    listed = counted.agg(F.collect_list(F.struct("slot", "rows")).alias("slots"), F.sum("rows").alias("total"))
    hot = F.filter("slots", lambda x: x["rows"] * parts > F.col("total"))
    pieces = F.transform(hot, lambda x: F.struct(x["slot"], F.ceil(x["rows"] * parts * PIECES_PER_TASK / F.col("total")).cast("int")))
    return listed.select(F.map_from_entries(pieces)).scalar()


def _pieces(hot: Column | int, keys: Sequence[Column]) -> Column:
    if isinstance(hot, int):
        return F.lit(hot)
    return F.coalesce(F.try_element_at(hot, slot(keys)), F.lit(1))


def dealt(df: DataFrame, keys: Sequence[str], hot: Column | int) -> DataFrame:
    """df with the piece that each row goes to, by a hash of its columns; a row with a null key goes
    anywhere. The piece follows from the row alone, so a task that runs again deals alike."""
    told_apart = [c for c in df.columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    row = F.xxhash64(*told_apart)
    lacking = F.greatest(*(F.col(k).isNull() for k in keys)) if len(keys) > 1 else F.col(keys[0]).isNull()
    pieces = _pieces(hot, [F.col(k) for k in keys])
    return df.withColumn(PIECE, F.when(lacking, F.pmod(row, F.lit(NULL_PIECES))).when(pieces > 1, F.pmod(row, pieces)).otherwise(0).cast("int"))


def copied(df: DataFrame, keys: Sequence[str], hot: Column | int, types: Sequence[T.DataType]) -> DataFrame:
    """df with each row once per piece of its slot; types are those of the left side's keys, which the
    slots are computed from."""
    alike = [F.col(k).try_cast(t) for k, t in zip(keys, types, strict=True)]
    return df.withColumn(PIECE, F.explode(F.sequence(F.lit(0), _pieces(hot, alike) - 1)))
