"""Hard negatives by threshold joins over an inverted index of dense vectors.

Rows are indexed in blocks. A block orders its dimensions by how much they carry and cuts them into
segments; the posting list of a segment holds the rows by the norm of what follows, largest first.
At a threshold, a segment of a row is left out of the index once the norm of the row's rest times
that of the query's rest stays below it: each list is read as a prefix, whatever the threshold is.
Partial scores add up list by list, pairs whose remaining norms can't lift them over the threshold
are pruned, and the rest is computed for what is left.

A search asks for the best rows of a window of scores. It starts with high thresholds and lowers
them, round by round, for the windows that are not full; the last threshold is the window's own
lower end, so the result is exact. Within a task a full window lifts its threshold at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_length, discard, in_waves, read_table, written

#: Posting lists of a block, at most: dimensions are taken together in so many segments.
SEGMENTS = 8
#: Rows of an index block, and anchors of a pack of queries: 2 MB each at 64 dimensions.
BLOCK_ROWS = 4096
#: Bytes of queries that one pass over the index asks at once; they are broadcast.
WAVE_BYTES = 32 << 20
#: How far a threshold goes down from a window's upper to its lower end, round by round.
STEPS = (1 / 8, 1 / 3, 1.0)
#: Norms are rounded up by this, so that no bound is too small.
_SLACK = 1 + 1e-9

_INDEX = "dim int, n long, ids binary, labels binary, dims binary, norms binary, lists binary, vectors binary"
_PACK = "dim int, pack long, n long, ids binary, labels binary, vectors binary, counts binary, windows binary, low binary, high binary, bar binary"
_FOUND = "id long, window long, score long, vec_id long"


def _borders(dim: int) -> np.ndarray:
    return np.unique(np.linspace(0, dim, min(SEGMENTS, dim) + 1).astype(int))


def suffix_norms(vectors: np.ndarray) -> np.ndarray:
    """Norms of what follows each border (borders x rows), rounded up; the last ones are 0."""
    squares = np.zeros((vectors.shape[1] + 1, len(vectors)))
    squares[:-1] = np.cumsum((vectors * vectors).T[::-1], axis=0)[::-1]
    return np.sqrt(squares[_borders(vectors.shape[1])]) * _SLACK


class Block:
    """The inverted index of some rows, all of one length."""

    def __init__(self, dims: np.ndarray, norms: np.ndarray, lists: np.ndarray, vectors: np.ndarray) -> None:
        self.dims, self.norms, self.lists, self.vectors = dims, norms, lists, vectors
        self.borders = _borders(vectors.shape[1])

    @classmethod
    def of(cls, vectors: np.ndarray) -> Block:
        dims = np.argsort(-(vectors * vectors).sum(axis=0), kind="stable").astype(np.int32)
        ordered = np.ascontiguousarray(vectors[:, dims])
        norms = suffix_norms(ordered)
        lists = np.argsort(-norms[:-1], axis=1, kind="stable").astype(np.int32)
        return cls(dims, norms, lists, ordered)

    def at_least(self, queries: np.ndarray, bars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of every pair whose score reaches the query's bar."""
        asked = queries[:, self.dims]
        rest = suffix_norms(asked)  # borders x queries
        partial = np.zeros((len(asked), len(self.vectors)))
        depth = np.zeros(len(self.vectors), int)  # segments of a row that are added up
        open_rows = np.ones(len(self.vectors), bool)
        for s, (a, b) in enumerate(zip(self.borders, self.borders[1:], strict=False)):
            with np.errstate(divide="ignore"):
                least = np.where(bars > 0, bars / rest[s], -np.inf).min()  # rows with less here are covered by their norms
            rows = self.lists[s]
            rows = rows[: np.searchsorted(-self.norms[s][rows], -least, "right")]
            rows = rows[open_rows[rows]]
            if not len(rows):
                break
            partial[:, rows] += asked[:, a:b] @ self.vectors[rows, a:b].T
            depth[rows] = s + 1
            reach = partial[:, rows] + rest[s + 1][:, None] * self.norms[s + 1][rows]
            open_rows[:] = False
            open_rows[rows] = (reach >= bars[:, None]).any(axis=0)
        reach = partial + rest[depth].T * self.norms[depth, np.arange(len(depth))]
        q, r = np.nonzero(reach >= bars[:, None])
        score = partial[q, r]
        short = np.flatnonzero(depth[r] < len(self.borders) - 1)
        for i in range(0, len(short), 1 << 16):
            some = short[i : i + (1 << 16)]
            score[some] = np.einsum("ij,ij->i", asked[q[some]], self.vectors[r[some]])
        kept = score >= bars[q]
        return q[kept], r[kept], score[kept]


def _index(vectors: DataFrame, block_rows: int) -> DataFrame:
    """A row per block of rows (id, label, v, dim)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def close(dim: int) -> pa.RecordBatch:
            ids, labels, vectors = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            b = Block.of(vectors)
            blobs = {"ids": ids, "labels": labels, "dims": b.dims, "norms": b.norms, "lists": b.lists, "vectors": b.vectors}
            return pa.record_batch({"dim": pa.array([dim], pa.int32()), "n": pa.array([len(ids)], pa.int64())} | {k: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for k, x in blobs.items()})

        for batch in batches:
            for dim, part, exact in by_length(batch):
                for i in range(0, len(exact), block_rows):
                    held.setdefault(dim, []).append((part["id"].to_numpy()[i : i + block_rows], part["label"].to_numpy()[i : i + block_rows], exact[i : i + block_rows]))
                    if sum(len(ids) for ids, _, _ in held[dim]) >= block_rows:
                        yield close(dim)
        for dim in list(held):
            yield close(dim)

    return vectors.select("id", "label", "dim", "v").mapInArrow(build, _INDEX)


def _packs(asked: DataFrame, pack_rows: int) -> DataFrame:
    """Queries (id, label, v, dim, windows: array of (window, low, high, bar)), some to a row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part, exact in by_length(batch):
                for i in range(0, len(exact), pack_rows):
                    some, windows = part.slice(i, pack_rows), part["windows"].slice(i, pack_rows).flatten()
                    counts = np.array([len(w) for w in some["windows"]], np.int64)
                    field = lambda name, windows=windows: np.asarray(windows.field(name).to_numpy(zero_copy_only=False))
                    blobs = {"ids": some["id"].to_numpy(), "labels": some["label"].to_numpy(), "vectors": exact[i : i + pack_rows], "counts": counts, "windows": field("window"), "low": field("low"), "high": field("high"), "bar": field("bar")}
                    yield pa.record_batch({"dim": pa.array([dim], pa.int32()), "n": pa.array([len(counts)], pa.int64())} | {k: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for k, x in blobs.items()})

    packed = asked.select("id", "label", "dim", "v", "windows").mapInArrow(pack, _PACK.replace("pack long, ", ""))
    return packed.withColumn("pack", F.monotonically_increasing_id())


class Best:
    """The best rows of the windows of one pack of queries, over the blocks of a task."""

    def __init__(self, row: dict, k: int, same_label: bool) -> None:
        self.k, self.same, n = k, same_label, row["n"]
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.labels = read("ids", np.int64), read("labels", np.int64)
        self.vectors = read("vectors", np.float64).reshape(n, row["dim"])
        counts = read("counts", np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.names, self.low, self.high = read("windows", np.int64), read("low", np.float64), read("high", np.float64)
        self.bars = read("bar", np.float64).copy()
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, block: Block, ids: np.ndarray, labels: np.ndarray, chunk: int = 128) -> None:
        lowest = np.minimum.reduceat(self.bars, self.first[:-1])  # every query has a window
        for a in range(0, len(self.ids), chunk):
            q, r, score = block.at_least(self.vectors[a : a + chunk], lowest[a : a + chunk])
            q = q + a
            own = self.labels[q] == labels[r]
            fits = (own if self.same else ~own) & (self.ids[q] != ids[r])
            q, r, score = q[fits], r[fits], score[fits]
            for w in range(int((self.first[1:] - self.first[:-1]).max(initial=0))):
                slot = self.first[q] + w
                there = slot < self.first[q + 1]
                slot, found, own_ids = slot[there], score[there], ids[r[there]]
                inside = (found >= self.bars[slot]) & (found >= self.low[slot]) & (found <= self.high[slot])
                self.held.append((slot[inside], found[inside], own_ids[inside]))
            if sum(len(x[0]) for x in self.held) > max(1 << 18, 2 * self.k * len(self.bars)):
                self.keep_best()
        self.keep_best()

    def keep_best(self) -> None:
        """Drop what k better rows of this task exclude, and lift the bars of full windows."""
        slot, score, ids = (np.concatenate(x) for x in zip(*self.held, strict=True)) if self.held else (np.zeros(0, int), np.zeros(0), np.zeros(0, np.int64))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        top = place < self.k
        last = place == self.k - 1
        self.bars[slot[last]] = np.maximum(self.bars[slot[last]], score[last])
        self.held = [(slot[top], score[top], ids[top])]

    def rows(self) -> pa.RecordBatch:
        slot, score, ids = self.held[0] if self.held else (np.zeros(0, int), np.zeros(0), np.zeros(0, np.int64))
        owner = np.searchsorted(self.first, slot, "right") - 1
        return pa.record_batch({"id": self.ids[owner], "window": self.names[slot], "score": score.astype(np.int64), "vec_id": ids})


def _scanned(index: DataFrame, packs: DataFrame, k: int, same_label: bool, wave_bytes: int) -> DataFrame:
    """_FOUND: up to k rows per window and task. Each wave of packs, at most wave_bytes, is broadcast
    to the blocks of its vector length, so that the index is never shuffled."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, Best] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_buffer() if pa.types.is_binary(batch[name].type) else batch[name][i].as_py() for name in batch.schema.names}
                n, dim = row["b_n"], row["dim"]
                segments = len(_borders(dim)) - 1
                block = Block(np.frombuffer(row["b_dims"], np.int32), np.frombuffer(row["b_norms"]).reshape(segments + 1, n), np.frombuffer(row["b_lists"], np.int32).reshape(segments, n), np.frombuffer(row["b_vectors"]).reshape(n, dim))
                if row["pack"] not in best:
                    best[row["pack"]] = Best(row | {k: bytes(v) for k, v in row.items() if isinstance(v, pa.Buffer) and not k.startswith("b_")}, k, same_label)
                best[row["pack"]].add(block, np.frombuffer(row["b_ids"], np.int64), np.frombuffer(row["b_labels"], np.int64))
        for one in best.values():
            yield one.rows()

    blocks = index.select("dim", *(F.col(c).alias(f"b_{c}") for c in index.columns if c != "dim"))
    waves = in_waves(packs, F.octet_length("vectors") + 4 * F.octet_length("bar"), wave_bytes)
    found = [blocks.join(F.broadcast(wave), "dim").mapInArrow(scan, _FOUND) for wave in waves]
    return reduce(DataFrame.unionByName, found) if found else index.sparkSession.createDataFrame([], _FOUND)


def best_in_windows(index: DataFrame, asked: DataFrame, *, k: int, same_label: bool, pack_rows: int = BLOCK_ROWS, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """(id, window, rank, vec_id, score): the k best rows with low <= score <= high of each window.

    asked: id, label, v, dim, window, low, high, one row per window, low finite. Rows are those of
    the query's label or, without same_label, of other labels, never of the query's own id.
    """
    results: list[DataFrame] = []
    open_ = asked
    for step in STEPS:
        bar = F.col("low") if step == 1 else F.col("high") - step * (F.col("high") - F.col("low"))
        grouped = open_.groupBy("id").agg(*(F.first(c).alias(c) for c in ("label", "v", "dim")), F.sort_array(F.collect_list(F.struct("window", "low", "high", bar.alias("bar")))).alias("windows"))
        packs = written(_packs(grouped, pack_rows), "negative-packs")
        found = written(_scanned(index, packs, k, same_label, wave_bytes), "negative-scans")
        order = Window.partitionBy("id", "window").orderBy(F.desc("score"), "vec_id")
        best = written(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "negative-best")
        discard(packs, found)
        if step == 1:
            results.append(best)
            break
        full = written(best.filter(F.col("rank") == k).select("id", "window"), "negative-full")
        results.append(best.join(full, ["id", "window"], "left_semi"))
        open_ = written(open_.join(full, ["id", "window"], "left_anti"), "negative-open")
        if open_.isEmpty():
            break
    return reduce(DataFrame.unionByName, results).select("id", "window", "rank", "vec_id", "score")


def _takes_part(label: Column, vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return label.isNotNull() & F.coalesce((F.size(vector) > 0) & whole, F.lit(False))


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, *, key: str = "vec_id", vector: str = "vector", label: str = "label", positives: int = 5, negatives: int = 10, low: tuple[int, int] = (30, 100), high: tuple[int, int] = (90, 100), block_rows: int = BLOCK_ROWS, pack_rows: int = BLOCK_ROWS, wave_bytes: int = WAVE_BYTES
) -> DataFrame:
    """For each anchor and each of its best rows of its own label, the best rows of other labels whose
    score lies between two shares of the positive's.

    Vectors are arrays of whole numbers as doubles; sums of products must stay below 2**53. anchors
    has the columns of rows and is asked against all rows but those with its own key. Returns
    anchor_id, positive_id, rank (int, from 1), negative_id, positive_score, negative_score (long).
    Ties go to the smaller key.

    Rows with a null key or label, or a vector that is null, empty, or holds null or non-finite
    components, take no part. Labels that are no whole numbers are told apart by 64-bit hashes. Only
    vectors of equal length are compared. An anchor key that occurs more than once is asked once,
    with the least of its labels and vectors. Rows that repeat are each a result. Without positives,
    with a positive score below 0, or with nothing in its window, an anchor has no result. Other
    columns, whatever their names, are left out. Empty tables give an empty result.
    """

    def prepared(df: DataFrame) -> DataFrame:
        whole = df.schema[label].dataType.typeName() in ("byte", "short", "integer", "long")
        own = F.col(label).cast("long") if whole else F.when(F.col(label).isNotNull(), F.xxhash64(label))
        slim = df.select(F.col(key).cast("long").alias("id"), own.alias("label"), F.col(vector).cast("array<double>").alias("v"))
        return slim.filter(F.col("id").isNotNull() & _takes_part(F.col("label"), F.col("v"))).withColumn("dim", F.size("v"))

    index = written(_index(prepared(rows), block_rows), "negative-index")
    first = F.min(F.struct("label", "v", "dim"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    asked = written(prepared(anchors).groupBy("id").agg(first.alias("x")).select("id", "x.*").withColumn("norm", norm), "negative-anchors")
    most = prepared(rows).agg(F.max(norm)).first()[0] or 0.0
    reach = (F.col("norm") + 1) * (most + 1) * _SLACK
    everything = asked.withColumns({"window": F.lit(0).cast("long"), "low": -reach, "high": reach}).drop("norm")
    more = {"pack_rows": pack_rows, "wave_bytes": wave_bytes}
    near = written(best_in_windows(index, everything, k=positives, same_label=True, **more).select("id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negative-positives")
    bounds = {"low": F.ceil(F.col("window") * low[0] / low[1]).cast("double"), "high": F.floor(F.col("window") * high[0] / high[1]).cast("double")}
    windows = near.select("id", F.col("positive_score").alias("window")).distinct().withColumns(bounds).filter("low <= high").join(asked.drop("norm"), "id")
    far = best_in_windows(index, written(windows, "negative-windows"), k=negatives, same_label=False, **more)
    far = written(far, "negative-results")
    discard(index)
    both = near.join(far, (near["id"] == far["id"]) & (near["positive_score"] == far["window"]))
    return both.select(near["id"].alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    whole = F.transform("embedding", lambda x: F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.floor(x.cast("double") * 256).cast("double")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", whole.alias("vector"), label.alias("label"))
    return hard_negatives(rows, rows.filter(F.col("vec_id") % 100 == 0))


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS own, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN scored s USING (anchor_id)
WHERE NOT s.own AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
"""
