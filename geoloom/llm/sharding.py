"""Two-pass external shuffle into shards.

Pass one scatters rows over memory-sized buckets by a seeded hash. Pass two reads one bucket after
the other, runs a Fisher-Yates shuffle over each and writes it. The written buckets, one after the
other, are a shuffled order of the whole table; shards are equal runs of that order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import each_group, read_table, written

_RUN, _BUCKET, _PART, _POS, _ORDER = "__sh_run", "__sh_bucket", "__sh_part", "__sh_pos", "__sh_order"

#: Buckets that one task of pass two works through, at most; 512 MB of the usual size.
RUN_BUCKETS = 64

def shuffle_to_shards(df: DataFrame, *, shards: int, key: str = "doc_id", text: str = "text", seed: int = 0, bucket_bytes: int = 8 << 20, least_buckets: int = 16) -> DataFrame:
    """Shuffle all rows and deal them to shards whose row counts differ by one at most.

    Returns df with size (UTF-8 bytes of text plus 1, long), shard (int) and slot (long, gapless
    from 0 in each shard, the shuffled order). The order depends on seed, keys and texts, not on how
    the table is laid out, unless rows of one key and text overfill a bucket: those are dealt over
    parts by their place in the table.

    A null text has size 1 and a null key is a key like others. Rows that repeat are all dealt. No
    task holds more than about two buckets' bytes and one row at once. An empty table gives an empty
    result. Other columns are passed through; those named size, shard or slot are replaced.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    base = df.drop("shard", "slot").withColumn("size", size)
    total = base.agg(F.sum("size")).first()[0] or 0
    buckets = max(least_buckets, -(-total // bucket_bytes))
    in_run = max(1, min(RUN_BUCKETS, buckets // 1024))
    placed = base.withColumn(_BUCKET, F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col(text)), F.lit(buckets)))
    heavy = placed.groupBy(_BUCKET).agg(F.sum("size").alias("__sh_bytes")).filter(F.col("__sh_bytes") > 2 * bucket_bytes)
    heavy = written(heavy.select(_BUCKET, F.ceil(F.col("__sh_bytes") / bucket_bytes).alias("__sh_parts")), "overfull-buckets")
    parts = heavy.agg(F.coalesce(F.sum("__sh_parts"), F.lit(0))).first()[0]
    row = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    placed = placed.withColumn("__sh_row", row).join(heavy, _BUCKET, "left")
    placed = placed.withColumn(_PART, F.coalesce(F.pmod("__sh_row", F.col("__sh_parts")), F.lit(0).cast("long"))).drop("__sh_parts", "__sh_row")
    # a run is what one task takes; parts of a bucket are runs of their own
    placed = placed.withColumn(_RUN, F.expr(f"{_BUCKET} div {in_run}")).withColumn(_ORDER, F.xxhash64(F.lit(seed + 1), F.col(key), F.col(text)))
    tasks = min(-(-buckets // in_run) + parts, 100_000)

    schema = T.StructType([*(f for f in placed.schema if f.name not in (_ORDER, _BUCKET)), T.StructField(_POS, T.LongType())])

    def fisher_yates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, at = None, 0
        for bucket in each_group(batches, [_RUN, _PART, _BUCKET]):
            name = (bucket[_RUN][0].as_py(), bucket[_PART][0].as_py())
            run, at = name, at if name == run else 0  # positions go on through the buckets of a run
            order = np.argsort(bucket[_ORDER].to_numpy(), kind="stable")  # the order rows came in is chance
            rng = np.random.default_rng([seed & 0xFFFFFFFF, bucket[_BUCKET][0].as_py(), name[1]])
            rng.shuffle(order)
            dealt = bucket.drop_columns([_ORDER, _BUCKET]).take(pa.array(order))
            yield from dealt.append_column(_POS, pa.array(at + np.arange(len(order)))).to_batches(10_000)
            at += len(order)

    # a run per task, without two in one by chance
    scattered = placed.repartitionById(tasks, F.pmod(F.col(_RUN) + F.col(_PART), F.lit(tasks)).cast("int")).sortWithinPartitions(_RUN, _PART, _BUCKET)
    shuffled = written(scattered.mapInArrow(fisher_yates, schema), "shuffled")
    return _deal(shuffled, shards)


def _deal(shuffled: DataFrame, shards: int) -> DataFrame:
    """Shards and slots of written runs, from the running sum of their row counts: one row per run,
    so that the sum is one small task. Spark knows the size of its result and broadcasts it, without
    a second shuffle, as long as it is small."""
    counts = written(shuffled.groupBy(_RUN, _PART).count(), "shuffled-counts")
    rows = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    before = Window.orderBy(_RUN, _PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(_RUN, _PART, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__sh_start"))
    place = F.col("__sh_start") + F.col(_POS)
    dealt = shuffled.join(starts, [_RUN, _PART]).withColumn("shard", F.expr(f"cast((__sh_start + {_POS}) * {shards} div {max(rows, 1)} as int)"))
    first = F.expr(f"(cast(shard as long) * {rows} + {shards - 1}) div {shards}")  # ceil(shard * rows / shards)
    return dealt.withColumn("slot", (place - first).cast("long")).drop(_RUN, _PART, _POS, "__sh_start")


def write_shards(dealt: DataFrame, path: str) -> None:
    """One folder per shard; rows in slot order within each of its files."""
    dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return shuffle_to_shards(docs, shards=8, seed=20240501).select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
