"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in numpy inside the tasks and sums the counts in Spark. The
matrix of log probabilities has a fixed width and is broadcast in blocks of languages; scoring adds
up its rows over the n-grams of a text. However many languages there are, each block is one pass
over the texts, and a text's best language and the sum of its probabilities go on from block to
block.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, written

#: Longest n-gram, in characters.
ORDERS = 3
#: Hash buckets, of all orders together.
BUCKETS = 1 << 16
#: Languages of a block, by the size of the matrix: about 64 rows of 512 KB. Blocks are dealt by hash.
BLOCK_LANGUAGES = 64
#: Characters that are worked on at once.
PIECE = 1 << 20
#: Stands behind the buckets for the number of rows of a language.
ROWS = BUCKETS
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, lower-cased, each run of other characters than letters as one
    space, a space around each text; and the text that each belongs to."""
    codes = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(c) + 2 for c in codes])
    blank = np.array([32], np.uint32)
    flat = np.concatenate([x for c in codes for x in (blank, c, blank)]) if codes else np.zeros(0, np.uint32)
    letter = _letters()[flat]
    first = np.ones(len(flat), bool)
    first[1:] = owner[1:] != owner[:-1]
    keep = letter | first
    keep[1:] |= letter[:-1]
    return np.where(letter, flat, 32)[keep].astype(np.uint32), owner[keep]


def features(codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of each n-gram within one text, order by order; the owners come in order."""
    for n in range(1, ORDERS + 1):
        if len(codes) < n:
            return
        mixed = np.full(len(codes) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for i in range(n):
            mixed = (mixed ^ codes[i : len(codes) - n + 1 + i]) * np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(15)
        within = owner[: len(mixed)] == owner[n - 1 :]
        if n == 1:
            within &= codes != 32
        yield (mixed[within] % np.uint32(BUCKETS)).astype(np.int64), owner[: len(mixed)][within]


def _pieces(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with about PIECE characters; a long text stands alone."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        if chars and chars + len(t) > PIECE:
            yield start, texts[start:i]
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, texts[start:]


def _slices(codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """features() over slices, each n-gram once, so that a long text needs little memory."""
    for at in range(0, max(len(codes), 1), PIECE):
        if at == 0 and len(codes) <= PIECE:
            yield from features(codes, owner)
            return
        cut, end = slice(at, at + PIECE + ORDERS - 1), min(at + PIECE, len(codes))
        for n, (bucket, text) in enumerate(features(codes[cut], owner[cut]), 1):
            starts = np.flatnonzero(_starts(codes[cut], owner[cut], n)) + at
            mine = starts < end
            yield bucket[mine], text[mine]


def _starts(codes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    within = owner[: len(codes) - n + 1] == owner[n - 1 :]
    return within & (codes != 32) if n == 1 else within


@dataclass(frozen=True)
class Block:
    """Log probabilities of some languages, languages by buckets; priors are uniform over all languages."""

    languages: tuple[str, ...]
    log_probability: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log likelihoods, texts by languages."""
        out = np.zeros((len(texts), len(self.languages)))
        for start, some in _pieces(texts):
            for bucket, text in _slices(*normalised(some)):
                for lang in range(len(self.languages)):
                    out[start : start + len(some), lang] += np.bincount(text, self.log_probability[lang][bucket], minlength=len(some))
        return out


@dataclass(frozen=True)
class Model:
    """Counts (l, bucket, n) of all languages as a written table, dealt into blocks."""

    counts: DataFrame
    blocks: int
    smoothing: float

    def block(self, i: int) -> Block:
        """Block i; its counts reach the driver as one value of 512 KB per language."""

        def pack(language: pa.Table) -> pa.Table:
            counts = np.zeros(BUCKETS, np.int64)
            counts[language["bucket"].to_numpy()] = language["n"].to_numpy()
            return pa.table({"l": language["l"].slice(0, 1), "counts": pa.array([counts.tobytes()], pa.binary())})

        mine = self.counts.filter(F.pmod(F.xxhash64("l"), F.lit(self.blocks)) == i)
        known = sorted(r["l"] for r in mine.filter(F.col("bucket") == ROWS).select("l").collect())
        learned = mine.filter(F.col("bucket") < BUCKETS).groupBy("l").applyInArrow(pack, "l string, counts binary").toArrow()
        counts = {name: np.frombuffer(blob.as_buffer(), np.int64) for name, blob in zip(learned["l"].to_pylist(), learned["counts"], strict=True)}
        log = np.zeros((len(known), BUCKETS))
        for own, name in zip(log, known, strict=True):
            own += counts.get(name, 0)
            own += self.smoothing
            np.log(own / own.sum(), out=own)
        return Block(tuple(known), log)


def train(df: DataFrame, *, text: str = "text", language: str = "lang", smoothing: float = 0.5) -> Model:
    """Learn from every row whose text and language are given; the counts cover whole texts.

    Every language value is learned, however many there are. Rows with a null text or language teach
    nothing. Without any row the model knows no language. Repeated rows count as often as they occur.
    A task counts BLOCK_LANGUAGES languages at once and hands their counts on before it takes others.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: Counter[str] = Counter()

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, own in sums.items():
                at = np.flatnonzero(own)
                yield pa.record_batch({"l": pa.array([lang] * (len(at) + 1), pa.string()), "bucket": pa.array(np.append(at, ROWS).astype(np.int32)), "n": pa.array(np.append(own[at], rows[lang]))})
            sums.clear()
            rows.clear()

        for batch in batches:
            by_language: dict[str, list[str]] = {}
            for own_text, lang in zip(batch["t"].to_pylist(), batch["l"].to_pylist(), strict=True):
                by_language.setdefault(lang, []).append(own_text)
            for lang, texts in by_language.items():
                if lang not in sums and len(sums) >= BLOCK_LANGUAGES:
                    yield from handed_on()
                own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                rows[lang] += len(texts)
                for _, some in _pieces(texts):
                    for bucket, _ in _slices(*normalised(some)):
                        own += np.bincount(bucket, minlength=BUCKETS)
        yield from handed_on()

    given = df.select(F.col(text).alias("t"), F.col(language).alias("l")).filter(F.col("t").isNotNull() & F.col("l").isNotNull())
    partial = given.mapInArrow(count, "l string, bucket int, n long")
    total = written(partial.groupBy("l", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    languages = total.filter(F.col("bucket") == ROWS).count()
    return Model(total, -(-languages // BLOCK_LANGUAGES), smoothing)


def _best_of_block(df: DataFrame, shared: Broadcast) -> DataFrame:
    """df without __li_text, with best (a language, null for a text without a letter), its log
    likelihood, and the block's likelihoods as multiples of that, summed."""
    schema = T.StructType([*(f for f in df.schema if f.name != "__li_text"), T.StructField("__li_best", T.StringType()), T.StructField("__li_log", T.DoubleType()), T.StructField("__li_sum", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Block = shared.value
        for batch in batches:
            texts = batch["__li_text"].fill_null("").to_pylist()
            names: list[str | None] = [None] * len(texts)
            best, sums = np.zeros(len(texts)), np.zeros(len(texts))
            spoken = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))] if known.languages else []
            if spoken:
                logs = known.scores([texts[i] for i in spoken])
                best[spoken] = logs.max(axis=1)
                sums[spoken] = np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                for i, lang in zip(spoken, logs.argmax(axis=1), strict=True):
                    names[i] = known.languages[lang]
            yield batch.drop_columns(["__li_text"]).append_column("__li_best", pa.array(names, pa.string())).append_column("__li_log", pa.array(best)).append_column("__li_sum", pa.array(sums))

    return df.mapInArrow(score, schema)


def predict(df: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """Add lang_pred (string) and score (double, posterior probability, 0 to 1) to every row.

    A text that is null, empty or without a letter is `und` with score 0, and so is any text under a
    model without languages. Ties go to the language that sorts first. Whole texts are scored, in
    slices of bounded memory. Columns of df named lang_pred or score are replaced, others pass
    through; rows that repeat get equal answers. An empty table gives an empty result.

    With one block of languages this is one pass without a shuffle. With more, rows are numbered and
    written, each block adds its best language per row, and the blocks' answers meet by row.
    """
    context = df.sparkSession.sparkContext
    kept = [c for c in df.columns if c not in ("lang_pred", "score")]
    plain = df.select(*kept, F.col(text).alias("__li_text"))
    if model.blocks <= 1:
        first = model.block(0) if model.blocks else Block((), np.zeros((0, BUCKETS)))
        found = _best_of_block(plain, context.broadcast(first))
        best, score = F.col("__li_best"), F.when(F.col("__li_best").isNotNull(), 1 / F.col("__li_sum"))
    else:
        numbered = written(plain.withColumn("__li_row", F.monotonically_increasing_id()), "language-rows")
        parts = []
        for i in range(model.blocks):
            shared = context.broadcast(model.block(i))
            parts.append(written(_best_of_block(numbered.select("__li_row", "__li_text"), shared).filter("__li_best IS NOT NULL"), "language-block"))
            shared.destroy()
        answer = F.struct("__li_log", "__li_sum", "__li_best")
        met = reduce(DataFrame.unionByName, parts).groupBy("__li_row").agg(F.min_by(answer, F.struct(-F.col("__li_log"), "__li_best")).alias("__li_top"), F.collect_list(answer).alias("__li_all"))  # an entry per block
        total = F.aggregate("__li_all", F.lit(0.0), lambda sums, x: sums + x["__li_sum"] * F.exp(x["__li_log"] - F.col("__li_top")["__li_log"]))
        found = numbered.drop("__li_text").join(met, "__li_row", "left")
        best, score = F.col("__li_top")["__li_best"], 1 / total
    return found.select(*kept, F.coalesce(best, F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce(score, F.lit(0.0)).alias("score"))


def held_out(key: Column) -> Column:
    """Documents that teach nothing: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    answers = predict(docs.select("doc_id", "text"), model)
    return answers.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
