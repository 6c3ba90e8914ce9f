"""Batch sinks: overwrite or append, create if missing, insert-only merge, rebuild or increment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can read a table there."""
    try:
        spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise
    return True


def write_batch(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> int:
    """Overwrite (the schema is replaced) or append; returns the rows of the table read back."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be overwrite or append")
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.option("mergeSchema", mode == "append").parquet(path).count()


def ensure_table(spark: SparkSession, path: str, schema: T.StructType | str) -> None:
    """Write an empty table of that schema unless there is one."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)


def new_rows(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the existing table does not have, one per key."""
    return df.dropDuplicates(list(keys)).join(existing.select(*keys), list(keys), "left_anti")


def insert_only(df: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Append rows with new keys and never touch others; a second call adds nothing. Returns rows added."""
    spark = df.sparkSession
    ensure_table(spark, path, df.schema)
    before = spark.read.parquet(path)
    fresh = new_rows(df, before, keys).select(before.columns)
    count = before.count()
    fresh.write.mode("append").parquet(path)
    return spark.read.parquet(path).count() - count


def rebuild_or_add(spark: SparkSession, path: str, build: Callable[[DataFrame | None], DataFrame], *, keys: Sequence[str], rebuild: bool = False) -> str:
    """Overwrite when asked to or when the table is missing, else build what is missing and insert it.

    build gets the existing table, or None for a full build. Returns which of the two was done.
    """
    if rebuild or not path_exists(spark, path):
        build(None).dropDuplicates(list(keys)).write.mode("overwrite").parquet(path)
        return "rebuilt"
    insert_only(build(spark.read.parquet(path)), path, keys)
    return "added"


def latest_per_key(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes last in order; nulls come first."""
    last = F.max_by(F.struct(*log.columns), F.struct(*order))
    return log.groupBy(*keys).agg(last.alias("__last")).select("__last.*")
