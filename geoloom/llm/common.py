"""What the operators of this package share: written tables, a filter before shuffles, and grouped Arrow streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import discard, fresh_path, shared_dir, written

__all__ = ["WHITE", "binary_texts", "by_length", "discard", "each_group", "fresh_path", "in_waves", "may_hold", "read_table", "shared_dir", "slots_for", "sorted_groups", "written"]

#: The ASCII white space that separates words: space and \x09 to \x0D.
WHITE = " \t\n\x0b\x0c\r"

#: Slots of the smallest and the largest bit map: 8 KB and 16 MB.
LEAST_SLOTS, MOST_SLOTS = 1 << 16, 1 << 27
#: Words of 64 slots that are a page of a bit map.
PAGE_WORDS = 4096


def slots_for(keys: int) -> int:
    """Slots of a bit map that so many keys fill to an eighth at most, a power of two up to 16 MB."""
    return min(max(1 << (8 * keys - 1).bit_length(), LEAST_SLOTS), MOST_SLOTS) if keys else LEAST_SLOTS


def may_hold(keys: DataFrame, slots: int = 1 << 23) -> Callable[..., Column]:
    """A test of columns against the rows of keys: false only where no row of keys holds the values.

    Keys set bits of one map of slots bits, which reaches tasks as the value of a scalar subquery. A
    bit that other values set lets a row through, so what follows must be exact by itself; far beyond
    slots keys nearly every row passes. Used to leave rows out before they are shuffled.
    """
    slot = F.pmod(F.xxhash64(*keys.columns), F.lit(slots))
    ones = keys.select(slot.alias("slot")).selectExpr("slot div 64 AS word", "shiftleft(1L, cast(slot % 64 AS int)) AS bits")
    every = keys.sparkSession.range(slots // 64).selectExpr("id AS word", "0L AS bits")
    words = ones.unionByName(every).groupBy("word").agg(F.expr("bit_or(bits)").alias("bits"))
    # words are put together in pages by many tasks, so that the last one holds few rows
    pages = words.groupBy(F.expr(f"word div {PAGE_WORDS}").alias("page")).agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("own"))
    bits = pages.agg(F.sort_array(F.collect_list(F.struct("page", "own")))["own"]).scalar()

    def test(*columns: Column | str) -> Column:
        at = F.pmod(F.xxhash64(*columns), F.lit(slots))
        page = F.get(bits, F.floor(at / (64 * PAGE_WORDS)).cast("int"))
        word = F.get(page, F.floor(at / 64).cast("int") % PAGE_WORDS)
        return F.call_function("shiftright", word, (at % 64).cast("int")).bitwiseAND(F.lit(1)) == 1

    return test


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def binary_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets, without a copy; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches that come sorted by keys; only the open group is held back."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and any(held[-1][k][held[-1].num_rows - 1] != batch[k][0] for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        cut = 0
        for k in keys:
            same = np.asarray(batch[k].to_numpy(zero_copy_only=False)) == batch[k][batch.num_rows - 1].as_py()
            cut = max(cut, batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0)
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def each_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table per group, from batches that come sorted by keys without nulls."""
    for table in sorted_groups(batches, keys):
        values = [table[k].to_numpy() for k in keys]
        begins = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([v[1:] != v[:-1] for v in values])]))
        for a, b in zip(begins, [*begins[1:], table.num_rows], strict=True):
            yield table.slice(a, b - a)


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(length, rows, matrix) for each length of the vectors v of a batch, as its column dim names it."""
    dims = batch["dim"].to_numpy()
    for dim in np.unique(dims).tolist():
        part = batch.filter(pa.array(dims == dim))
        yield dim, part, part["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def in_waves(packs: DataFrame, size: Column, wave_bytes: int) -> list[DataFrame]:
    """Packs of queries, numbered in column pack, in runs of at most wave_bytes, or of one pack.

    What reaches the driver is a number and a size per pack; a run is small enough to be broadcast.
    """
    waves: list[list[int]] = []
    room = 0
    for name, own in packs.select("pack", size.alias("size")).orderBy("pack").collect():
        if not waves or own > room:
            waves.append([])
            room = wave_bytes
        waves[-1].append(name)
        room -= own
    return [packs.filter(F.col("pack").isin(wave)) for wave in waves]
