"""Exact top-k search by inner product over vector-approximation files.

Vectors are written once, and beside them an approximation file: one byte per component, the cell of
a grid whose borders are quantiles. A search scans the cells of all rows, which give bounds on every
score; rows that k others are certain to beat are left out. Exact vectors are read for the rest, in
the order of their upper bounds, until no row left can reach the k-th score: k rows of each query
first, then twice as many each time.

Queries go to the blocks of codes in waves that are broadcast, so that codes are never shuffled, and
a task keeps the k-th lower bound of each query over all its blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_length, discard, in_waves, may_hold, read_table, written

#: Cells of a component: a code is one byte.
CELLS = 256
#: Bytes of queries that one pass over the codes asks at once.
WAVE_BYTES = 32 << 20
#: Pairs that a task holds before it drops those that better ones exclude.
HELD = 1 << 20


class Grid:
    """Cells of whole-numbered vectors: codes, and bounds on inner products from codes alone.

    A component has a cell per value if it has few values; else cells hold equally many rows, so an
    outlying value widens the bounds of its own cell only. A cell is known by the least and greatest
    value in it (dim x CELLS, the last cell repeated), halves of whole numbers, so every sum here is
    exact.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray) -> None:
        self.low, self.high = low, high

    @classmethod
    def around(cls, vectors: np.ndarray) -> Grid:
        at = np.arange(1, CELLS + 1) * len(vectors) // CELLS - 1
        low, high = [], []
        for column in np.sort(vectors, axis=0).T:
            values = np.unique(column)
            ends = values if len(values) <= CELLS else np.unique(column[at])
            begins = np.append(values[0], values[np.searchsorted(values, ends[:-1], side="right")])
            pad = (0, CELLS - len(ends))
            low.append(np.pad(begins, pad, mode="edge")), high.append(np.pad(ends, pad, mode="edge"))
        return cls(np.array(low), np.array(high))

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Codes of the vectors that the grid was made around."""
        return np.stack([np.searchsorted(high, column) for high, column in zip(self.high, vectors.T, strict=True)], axis=1).astype(np.uint8)

    def boxes(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centres of rows' cells, and how far values may lie from them (dim x rows)."""
        at = np.arange(len(self.low))
        low, high = self.low[at, codes].T, self.high[at, codes].T
        return (low + high) / 2, (high - low) / 2


def bounds(boxes: tuple[np.ndarray, np.ndarray], queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds on the scores of rows in boxes (queries x rows)."""
    middle, half = boxes
    centres = queries @ middle
    if not half.any():
        return centres, centres
    radius = np.abs(queries) @ half
    return centres - radius, centres + radius


def _approximated(vectors: DataFrame, rows_per_block: int) -> DataFrame:
    """A row per block of the approximation file: ids, rows, codes and the grid."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def close(dim: int) -> pa.RecordBatch:
            ids, rows, exact = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            grid = Grid.around(exact)
            block = {"dim": pa.array([dim], pa.int32()), "block": pa.array([rows[0]], pa.int64()), "n": pa.array([len(ids)], pa.int64())}
            blobs = {"ids": ids, "rows": rows, "codes": grid.codes(exact), "low": grid.low, "high": grid.high}
            return pa.record_batch(block | {name: pa.array([x.tobytes()], pa.binary()) for name, x in blobs.items()})

        for batch in batches:
            for dim, part, exact in by_length(batch):
                held.setdefault(dim, []).append((part["id"].to_numpy(), part["row"].to_numpy(), exact))
                if sum(len(ids) for ids, _, _ in held[dim]) >= rows_per_block:
                    yield close(dim)
        for dim in list(held):
            yield close(dim)

    return vectors.select("row", "id", "dim", "v").mapInArrow(encode, "dim int, block long, n long, ids binary, rows binary, codes binary, low binary, high binary")


def _packs(asked: DataFrame, pack_rows: int) -> DataFrame:
    """Queries (id, dim, v), some to a row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part, exact in by_length(batch):
                for i in range(0, len(exact), pack_rows):
                    blobs = {"asked": part["id"].to_numpy()[i : i + pack_rows], "vectors": exact[i : i + pack_rows]}
                    yield pa.record_batch({"dim": pa.array([dim], pa.int32())} | {k: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for k, x in blobs.items()})

    return asked.select("id", "dim", "v").mapInArrow(pack, "dim int, asked binary, vectors binary").withColumn("pack", F.monotonically_increasing_id())


def _undominated(k: int, q: np.ndarray, ids: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Which pairs can be among the k best of their query: those that fewer than k others are certain
    to beat, by a score or by the smaller id at the same score."""
    order = np.lexsort((ids, -lower, q))
    begins = np.flatnonzero(np.diff(q[order], prepend=-1))
    full = np.diff(np.append(begins, len(q))) >= k
    bar, bar_id = np.full(int(q.max(initial=-1)) + 1, -np.inf), np.full(int(q.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    last = order[begins[full] + k - 1]
    bar[q[last]], bar_id[q[last]] = lower[last], ids[last]
    return (upper > bar[q]) | ((upper == bar[q]) & (ids <= bar_id[q]))


class _Bounded:
    """What a task knows of one pack: the k best lower bounds of each query, and pairs that reach them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.lower = np.full((len(ids), k), -np.inf)
        self.held: list[tuple[np.ndarray, ...]] = []

    def add(self, grid: Grid, codes: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        boxes = grid.boxes(codes)
        for i in range(0, len(self.ids), 128):
            lower, upper = bounds(boxes, self.vectors[i : i + 128])
            own = self.ids[i : i + 128, None] == ids[None, :]  # not a query's own row
            best = np.concatenate([self.lower[i : i + 128], np.where(own, -np.inf, lower)], axis=1)
            self.lower[i : i + 128] = np.partition(best, best.shape[1] - self.k, axis=1)[:, -self.k :]
            q, r = np.nonzero((upper >= self.lower[i : i + 128].min(axis=1)[:, None]) & ~own)
            pairs = (i + q, ids[r], rows[r], lower[q, r], upper[q, r])
            self.held.append(self._kept(pairs))

    def _kept(self, pairs: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        q, ids, _, lower, upper = pairs
        kept = _undominated(self.k, q, ids, lower, upper)
        return tuple(x[kept] for x in pairs)

    def size(self) -> int:
        return sum(len(x[0]) for x in self.held)

    def reaching(self) -> tuple[np.ndarray, ...]:
        """All pairs held that can be among the k best of the rows seen so far."""
        if not self.held:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0),) * 2
        pairs = tuple(np.concatenate(x) for x in zip(*self.held, strict=True))
        kept = pairs[4] >= self.lower.min(axis=1)[pairs[0]]
        return self._kept(tuple(x[kept] for x in pairs))

    def given_out(self) -> pa.RecordBatch:
        q, ids, rows, lower, upper = self.reaching()
        self.held = []
        return pa.record_batch({"query_id": pa.array(self.ids[q], pa.int64()), "id": pa.array(ids, pa.int64()), "row": pa.array(rows, pa.int64()), "lower": pa.array(lower), "upper": pa.array(upper)})


def _scanned(blocks: DataFrame, asked: DataFrame, k: int, queries_per_pack: int, wave_bytes: int) -> DataFrame:
    """(query_id, id, row, lower, upper): rows that may be among the k best of a query."""
    schema = "query_id long, id long, row long, lower double, upper double"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs: dict[int, _Bounded] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                raw = lambda name, kind: np.frombuffer(batch[name][i].as_buffer(), kind)  # noqa: B023, E731
                dim, n, pack = (batch[name][i].as_py() for name in ("dim", "n", "pack"))
                if pack not in packs:
                    packs[pack] = _Bounded(raw("asked", np.int64).copy(), raw("vectors", np.float64).reshape(-1, dim).copy(), k)
                found = packs[pack]
                grid = Grid(raw("low", np.float64).reshape(dim, CELLS), raw("high", np.float64).reshape(dim, CELLS))
                found.add(grid, raw("codes", np.uint8).reshape(n, dim), raw("ids", np.int64), raw("rows", np.int64))
                if found.size() > HELD:
                    found.held = [found.reaching()]
                    if found.size() > HELD // 2:  # bounds too wide to tell: they go on as they are
                        yield found.given_out()
        for found in packs.values():
            yield found.given_out()

    packs = written(_packs(asked, queries_per_pack), "query-packs")
    waves = in_waves(packs, F.octet_length("vectors") + 8 * k * F.octet_length("asked"), wave_bytes)
    found = [blocks.join(F.broadcast(wave), "dim").mapInArrow(scan, schema) for wave in waves]
    return reduce(DataFrame.unionByName, found) if found else blocks.sparkSession.createDataFrame([], schema)


def _best(rows: DataFrame, k: int, *order: Column | str) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= k)


def _place(value: str, *ids: str) -> Column:
    """What orders rows by a value, and by smaller ids at the same value; greater is better."""
    return F.struct(F.col(value).cast("double"), *(F.bitwise_not(i) for i in ids))


def _reaching(rows: DataFrame, certain: DataFrame, k: int) -> DataFrame:
    """Rows whose upper bound reaches the least of a query's k best certain scores (query_id, score, vec_id)."""
    bars = certain.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min(_place("score", "vec_id"))).alias("bar"))
    reached = F.col("bar").isNull() | (_place("upper", "id") >= F.col("bar"))
    return rows.join(written(bars, "bars"), "query_id").filter(reached).drop("bar")


def exact_scores(pairs: DataFrame, vectors: DataFrame, asked: DataFrame) -> DataFrame:
    """(query_id, vec_id, score) of pairs (query_id, row): the one place that reads exact vectors."""
    wanted = vectors.filter(may_hold(pairs.select("row"))("row")).select("row", F.col("id").alias("vec_id"), "v")
    both = pairs.select("query_id", "row").join(wanted, "row").join(asked.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id")
    score = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)
    return both.select("query_id", "vec_id", score.cast("long").alias("score"))


def exact_top_k(rows: DataFrame, queries: DataFrame, *, key: str = "vec_id", vector: str = "vector", k: int = 5, rows_per_block: int = 16384, queries_per_pack: int = 1024, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """For each query the k rows with the highest inner product, other than rows with its own key.

    Vectors are arrays of whole numbers as doubles; sums of products must stay below 2**52. Returns
    query_id, rank (int, from 1), the key as vec_id, score (long). Ties go to the smaller key.

    Rows or queries whose vector is null, or holds null or non-finite components, take no part, nor
    do those with a null key. Only vectors of equal length are compared. A query key that occurs
    more than once is asked once, with the least of its vectors. Rows that repeat are each a result.
    Other columns are left out. Empty tables give an empty result, and fewer than k rows give fewer
    results.
    """
    columns = (F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    vectors = rows.select(*columns).filter(F.col("id").isNotNull() & _whole(F.col("v"))).withColumn("dim", F.size("v"))
    vectors = written(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = queries.select(*columns).filter(F.col("id").isNotNull() & _whole(F.col("v"))).groupBy("id").agg(F.min("v").alias("v"))
    asked = written(asked.withColumn("dim", F.size("v")), "queries")
    blocks = written(_approximated(vectors, rows_per_block), "approximation")
    found = written(_scanned(blocks, asked, k, queries_per_pack, wave_bytes), "bounded")
    lower = _best(found, k, F.desc("lower"), "id").select("query_id", F.col("lower").alias("score"), F.col("id").alias("vec_id"))
    left = written(_reaching(found, lower, k).withColumn("place", _place("upper", "id", "row")), "candidates")
    discard(blocks, found)
    scores, step = None, k
    while True:
        now = written(_best(left, step, F.desc("place")), "read-next")
        new = written(exact_scores(now, vectors, asked), "new-scores")
        scores = new if scores is None else scores.unionByName(new)
        # whatever comes after the last row read, in the order of bounds, and can still be a result
        later = left.join(now.groupBy("query_id").agg(F.min("place").alias("end")), "query_id").filter(F.col("place") < F.col("end")).drop("end")
        left, old = written(_reaching(later, _best(scores, k, F.desc("score"), "vec_id"), k), "candidates"), left
        discard(old, now)
        if left.isEmpty():
            break
        step *= 2
    discard(vectors, asked)
    return _best(scores, k, F.desc("score"), "vec_id").select("query_id", "rank", "vec_id", "score")


def _whole(vector: Column) -> Column:
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)), F.lit(False))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    whole = F.transform("embedding", lambda x: F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), x.cast("double") * 256))
    vectors = vectors.select("vec_id", F.transform(whole, lambda x: F.floor(x).cast("double")).alias("vector"))
    return exact_top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_dot_product(q.v, r.v)::BIGINT AS score
  FROM v q JOIN v r ON q.vec_id % 50 = 0 AND r.vec_id <> q.vec_id),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
