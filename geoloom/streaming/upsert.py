"""Keyed upsert of micro-batches without a transactional table.

Each batch is one partition of a change log, overwritten as a whole, so a replayed batch leaves the
same log. Readers see the row of each key with the highest batch: the last batch wins. compact()
folds older batches into one, so the log holds the state and a few batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import delete_folder
from ..sources.sinks import latest_per_key, path_exists

BATCH = "__batch_id"


def upsert_batch(batch: DataFrame, batch_id: int, *, log: str, deduplicate: Callable[[DataFrame], DataFrame]) -> None:
    """Write one batch, deduplicated, into its own partition; an empty batch writes nothing."""
    if batch.isEmpty():
        return
    rows = deduplicate(batch).withColumn(BATCH, F.lit(batch_id).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(log)


def current(spark: SparkSession, log: str, keys: Sequence[str]) -> DataFrame:
    """The last state of every key."""
    return latest_per_key(spark.read.option("mergeSchema", True).parquet(log), keys, [BATCH]).drop(BATCH)


def batches(spark: SparkSession, log: str) -> list[int]:
    """Numbers of the batches that the log holds, in order; a name each, no rows."""
    return sorted(r[0] for r in spark.read.option("mergeSchema", True).parquet(log).select(BATCH).distinct().collect())


def compact(spark: SparkSession, log: str, keys: Sequence[str], *, keep: int = 8) -> int:
    """Fold all batches but the last into one, once there are more than keep; returns batches folded.

    The state up to the last batch but one is added to that batch's partition, and older partitions
    go. Only the last batch can be replayed, and its partition stays as it is. A crash leaves rows
    that are all true for their batch, so readers see the same state at any moment and a repeated
    call finishes the work.
    """
    known = batches(spark, log)
    if len(known) <= max(keep, 2):
        return 0
    upto, older = known[-2], known[:-2]
    history = spark.read.option("mergeSchema", True).parquet(log).filter(F.col(BATCH) <= upto)
    state = latest_per_key(history, keys, [BATCH]).withColumn(BATCH, F.lit(upto).cast("long"))
    state.write.mode("append").partitionBy(BATCH).parquet(log)
    for n in older:
        delete_folder(f"{log.rstrip('/')}/{BATCH}={n}")
    return len(older)


def drain_upserts(stream: DataFrame, *, log: str, checkpoint: str, deduplicate: Callable[[DataFrame], DataFrame], keys: Sequence[str] = (), keep: int = 8) -> None:
    """Upsert all that is new since the checkpoint, then stop. With keys, the log is compacted once it
    holds more than keep batches, so reading it costs the state and a few batches, not its history."""
    sink = stream.writeStream.foreachBatch(lambda df, n: upsert_batch(df, n, log=log, deduplicate=deduplicate))
    sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if keys and has_log(stream.sparkSession, log):
        compact(stream.sparkSession, log, keys, keep=keep)


def upserted(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """base with the rows of changes in place of those with the same keys, and the new ones added.

    changes must hold each key once.
    """
    return base.join(changes.select(*keys), list(keys), "left_anti").unionByName(changes)


def has_log(spark: SparkSession, log: str) -> bool:
    return path_exists(spark, log)
