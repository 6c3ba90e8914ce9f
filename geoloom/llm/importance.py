"""Importance resampling: draw the documents of a corpus that look most like a target corpus.

Words come from an untrained pre-tokenizer, a Regex Split over ASCII-lowered text. Every run of a
few consecutive words is a window from one word's start to another's end; its CRC names a bucket.
The gain of a bucket is the log ratio of its share in the target to its share in the corpus, a
document's weight the mean gain of its features, and Gumbel noise turns weights into a draw without
replacement. Texts are tokenized once: their buckets are written, two bytes a feature.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from .common import discard, read_table, written

#: Runs of digits, lower-case letters and all that is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SEPARATOR = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Characters that are pre-tokenized at once.
PIECE = 1 << 18


@lru_cache(1)
def _splitter() -> pre_tokenizers.PreTokenizer:
    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def ascii_lowered(text: str) -> str:
    return text.encode().lower().decode()


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in runs of about size characters that end before a separator; a longer word stays whole."""
    at = 0
    while len(text) - at > size:
        cut = _SEPARATOR.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def feature_crcs(text: str, longest: int, size: int = PIECE) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, CRCs of the features that end in them), piece by piece of a text.

    A feature is a run of 1 to longest words joined by one space: a window over the joined words
    from one word's start to another's end. Windows that began in the piece before go on.
    """
    before: list[bytes] = []
    for piece in pieces(ascii_lowered(text), size):
        words = [word.encode() for word, _ in _splitter().pre_tokenize_str(piece)]
        if not words:
            continue
        run = before + words
        joined = memoryview(b" ".join(run))
        ends = list(accumulate(map(len, run), lambda end, n: end + 1 + n))
        starts = [0, *(end + 1 for end in ends[:-1])]
        crcs = []
        for n in range(1, longest + 1):
            first = max(0, len(before) - n + 1)  # windows that end in a new word
            crcs += [zlib.crc32(joined[a:b]) for a, b in zip(starts[first:], ends[first + n - 1 :], strict=False)]
        yield len(words), np.array(crcs, np.uint32)
        before = run[len(run) - longest + 1 :] if longest > 1 else []


def _bucket_type(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def features(df: DataFrame, *, text: str, key: str, buckets: int, longest: int) -> DataFrame:
    """(key, n_words, n_features, buckets): the bucket of every feature of every whole text."""
    kind = _bucket_type(buckets)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, blobs = [], []
            for one in batch["t"].fill_null("").to_pylist():
                parts = list(feature_crcs(one, longest))
                words.append(sum(n for n, _ in parts))
                blobs.append(b"".join((crcs % np.uint32(buckets)).astype(kind).tobytes() for _, crcs in parts))
            counts = pa.array([len(b) // kind.itemsize for b in blobs], pa.int64())
            yield pa.record_batch({"k": batch["k"], "n_words": pa.array(words, pa.int64()), "n_features": counts, "buckets": pa.array(blobs, pa.binary())})

    named = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return named.mapInArrow(tokenize, f"k {named.schema['k'].dataType.simpleString()}, n_words long, n_features long, buckets binary")


def histogram(found: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) of features(): counts add up within a task before they are shuffled."""
    kind = _bucket_type(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for blob in batch["buckets"]:
                sums += np.bincount(np.frombuffer(blob.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.record_batch({"bucket": pa.array(at, pa.int64()), "n": pa.array(sums[at])})

    return found.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln) of target share over corpus share, one added to each count; a number a bucket."""
    both = target.select("bucket", F.col("n").alias("t"), F.lit(0).alias("s")).unionByName(corpus.select("bucket", F.lit(0).alias("t"), F.col("n").alias("s")))
    rows = both.groupBy("bucket").agg(F.sum("t").alias("t"), F.sum("s").alias("s")).toArrow()  # a row per bucket
    t, s = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    t[rows["bucket"].to_numpy()], s[rows["bucket"].to_numpy()] = rows["t"].to_numpy(), rows["s"].to_numpy()
    ratio = ((t + 1) * float(s.sum() + buckets)) / ((s + 1) * float(t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(found: DataFrame, gains: np.ndarray) -> DataFrame:
    """(key, n_words, n_features, weight): the floored mean of gains, 0 without a feature."""
    kind = _bucket_type(len(gains))
    shared = found.sparkSession.sparkContext.broadcast(gains)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(blob.as_buffer(), kind) for blob in batch["buckets"]]
            means = [int(shared.value[b].sum()) // len(b) if len(b) else 0 for b in own]
            yield batch.drop_columns(["buckets"]).append_column("weight", pa.array(means, pa.int64()))

    kept = found.schema["k"].dataType.simpleString()
    return found.mapInArrow(add_up, f"k {kept}, n_words long, n_features long, weight long")


def draw(weighted: DataFrame, *, key: str, share: tuple[int, int], least_words: int, seed: int) -> DataFrame:
    """Add score and rank to rows (key, n_words, weight): Gumbel top-k over all rows of enough words.

    The score is the weight and floored noise of the key's hash, in thousandths. The ranks 1, 2, 3
    go by falling score, ties by rising key with nulls last, to floor(rows * share); other rows have
    null. Scores are whole numbers within about 50,000 of 0, so the table of their counts is small
    at any size of the corpus. It gives the score of the last place; rows from there on are sorted
    by range, where a key that repeats is dealt over many tasks.
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = written(weighted.withColumn("score", (F.col("weight") + noise).cast("long")).withColumn("__row", F.monotonically_increasing_id()), "importance-scores")
    enough = F.col("n_words") >= least_words
    counts = written(scored.filter(enough).groupBy("score").count(), "importance-counts")
    wanted = (counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0] * share[0]) // share[1]
    reach = counts.withColumn("upto", F.sum("count").over(Window.orderBy(F.desc("score"))))
    last = reach.filter(F.col("upto") >= wanted).agg(F.max("score")).first()[0] if wanted else None
    near = enough & (F.col("score") >= last) if last is not None else F.lit(False)
    partitions = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.asc_nulls_last(key), F.asc("__row")]
    placed = scored.filter(near).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("__at", F.monotonically_increasing_id()), "importance-order")
    part, within = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("__part")).count()  # a row per partition
    starts = sizes.select("__part", (F.sum("count").over(Window.orderBy("__part")) - F.col("count")).alias("__start"))
    ranked = placed.withColumn("__part", part).join(starts, "__part").withColumn("rank", (F.col("__start") + within + 1).cast("long"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).drop("__part", "__start", "__at")
    rest = scored.filter(~F.coalesce(near, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop("__row")


def importance_weights(df: DataFrame, target: DataFrame, *, text: str = "text", key: str = "doc_id", target_text: str = "text", buckets: int = 10_000, longest: int = 2) -> DataFrame:
    """(key, n_words, n_features, weight) of every row of df against the texts of target.

    A null or empty text has no words and weight 0, and so has one without a letter or digit. Texts
    of any length are taken whole, in pieces of bounded memory. Rows that repeat get equal answers,
    a null key passes through. With an empty target every gain follows from the corpus alone; an
    empty df gives an empty result. Other columns, whatever their names, are left out.
    """
    found = written(features(df, text=text, key=key, buckets=buckets, longest=longest), "importance-features")
    aimed = features(target.withColumn("__key", F.lit(0)), text=target_text, key="__key", buckets=buckets, longest=longest)
    gains = bucket_gains(histogram(found, buckets), histogram(aimed, buckets), buckets)
    out = written(weigh(found, gains), "importance-weights")
    discard(found)
    return out.withColumnRenamed("k", key)


def resample(df: DataFrame, target: DataFrame, *, text: str = "text", key: str = "doc_id", share: tuple[int, int] = (25, 100), least_words: int = 20, seed: int = 7, **more) -> DataFrame:
    """The rows of df that are drawn, with all their columns: share of those with least_words words.

    Keys are to be unique; a key that repeats is kept in all its rows once one of them is drawn.
    """
    drawn = draw(importance_weights(df, target, text=text, key=key, **more), key=key, share=share, least_words=least_words, seed=seed)
    names = drawn.filter(F.col("rank").isNotNull()).select(F.col(key).alias("__drawn"))
    return df.join(names, F.col(key).eqNullSafe(F.col("__drawn")), "left_semi")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = importance_weights(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return draw(weighted, key="doc_id", share=(25, 100), least_words=20, seed=7).select("doc_id", "n_features", "weight", "score", "rank")


#: CRCs of distinct features by a table of bytes that the SQL makes itself (3988292384: the reflected
#: polynomial); words and windows as lists.
OP12_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT range AS b, range AS c, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
d AS (
  SELECT row_number() OVER () AS r, doc_id, w FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)),
g AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (
  SELECT r, unnest(w) AS f FROM d
  UNION ALL SELECT r, unnest(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) FROM d),
gf AS (
  SELECT unnest(w) AS f FROM g
  UNION ALL SELECT unnest(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) FROM g),
bytes AS (
  SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM df UNION SELECT f FROM gf)),
b AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
    lambda c, y: xor(t[xor(c & 255, y) + 1], c >> 8)), 4294967295::BIGINT) % 10000 AS b
  FROM bytes, crc),
s AS (SELECT b, count(*) AS s FROM df JOIN b USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM gf JOIN b USING (f) GROUP BY b),
total AS (SELECT (SELECT count(*) FROM df) AS ss, (SELECT count(*) FROM gf) AS tt),
gain AS (
  SELECT s.b, floor(1000 * ln(((coalesce(t, 0) + 1) * (ss + 10000)::DOUBLE) / ((s + 1) * (tt + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (b), total),
w AS (SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM df JOIN b USING (f) JOIN gain USING (b) GROUP BY r),
h AS (SELECT r, doc_id, len(w) AS words, ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d),
scored AS (
  SELECT r, doc_id, words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM h LEFT JOIN w USING (r)),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS rows FROM scored WHERE words >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= 25 * rows // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (r)
"""
