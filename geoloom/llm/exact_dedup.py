"""Exact deduplication by progressive refinement, with DataFrame functions only.

Three rounds: rows are grouped by text length; rows of a length that two share by a hash of a short
prefix as well; rows that are still together by a hash of the full text. A round learns which groups
of the round before are open from a bit map, sized by the number of open groups, so texts are read
where they lie and are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, may_hold, read_table, slots_for, written

_LEN, _HEAD, _FULL, _ROW = "__xd_length", "__xd_head", "__xd_full", "__xd_row"


def exact_duplicates(df: DataFrame, *, text: str = "text", key: str = "doc_id", prefix_chars: int = 64, carry: tuple[str, ...] = ()) -> DataFrame:
    """Which row of each group of equal texts stays: the one with the largest key.

    Returns a row per input row: key, the columns named in carry, keep_id (key of the row that
    stays), group_size (long), kept (boolean).

    A null text equals an empty one. A null key sorts below all others. Of rows that repeat both
    text and key, exactly one is kept. Texts of any length take part whole. An empty table gives an
    empty result. Other columns of df, whatever their names, are left out.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    length, head, full = F.octet_length(value), F.xxhash64(F.substring(value, 1, prefix_chars)), F.unhex(F.sha2(value, 256))
    # Counts combine within each task before the shuffle, so a length or prefix that a third of all
    # rows share sends one row per task.
    lengths = written(df.groupBy(length.alias(_LEN)).count().filter("count > 1").select(_LEN), "open-lengths")
    in_lengths = may_hold(lengths, slots_for(lengths.count()))
    heads = df.filter(in_lengths(length)).groupBy(length.alias(_LEN), head.alias(_HEAD)).count().filter("count > 1").select(_LEN, _HEAD)
    heads = written(heads, "open-heads")
    in_heads = may_hold(heads, slots_for(heads.count()))
    rows = df.select(F.col(key).alias(key), *(F.col(c) for c in carry), length.alias(_LEN), F.when(in_heads(length, head), full).alias(_FULL), F.monotonically_increasing_id().alias(_ROW))
    refined = written(rows, "exact-dedup")
    discard(lengths, heads)
    last: Column = F.struct(F.col(key).alias("key"), F.col(_ROW).alias("row"))
    groups = refined.filter(F.col(_FULL).isNotNull()).groupBy(_LEN, _FULL).agg(F.max(last).alias("__xd_last"), F.count(F.lit(1)).alias("__xd_size")).filter("__xd_size > 1")
    groups = written(groups, "exact-groups")  # a join of two plain exchanges is one that Spark can split by size
    # rows that stand alone get a length of their own, so that the join deals them evenly
    spread = refined.withColumn(_LEN, F.when(F.col(_FULL).isNull(), -1 - F.pmod(F.col(_ROW), F.lit(1 << 30))).otherwise(F.col(_LEN)).cast("int"))
    joined = spread.join(groups, [_LEN, _FULL], "left")
    grouped = F.col("__xd_size").isNotNull()
    return joined.select(
        key,
        *carry,
        F.when(grouped, F.col("__xd_last.key")).otherwise(F.col(key)).alias("keep_id"),
        F.coalesce(F.col("__xd_size"), F.lit(1)).cast("long").alias("group_size"),
        F.when(grouped, F.col("__xd_last.row") == F.col(_ROW)).otherwise(F.lit(True)).alias("kept"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return exact_duplicates(docs, carry=("text_sha256",)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP10_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
