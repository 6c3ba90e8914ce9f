"""Dropping lines that many documents share, with DataFrame functions only.

Lines are exploded and hashed, distinct documents are counted per hash, lines over the threshold
go except in the first document that holds them, and texts are put together again by position.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, read_table, written

_TH, _POS, _H1, _H2 = "__ld_text_hash", "__ld_pos", "__ld_h1", "__ld_h2"


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case and nothing else changed."""
    trimmed = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(trimmed) == F.char_length(trimmed)
    return F.when(ascii_only, F.lower(trimmed)).otherwise(F.translate(trimmed, string.ascii_uppercase, string.ascii_lowercase))


def drop_shared_lines(df: DataFrame, *, text: str = "text", key: str = "doc_id", min_chars: int = 10, min_documents: int = 2) -> DataFrame:
    r"""Drop lines whose key stands in min_documents documents or more, but for the first of them.

    Returns df with the text column replaced by the lines that stay, joined by \n, and two more
    columns: n_lines (lines before, long) and n_dropped (long).

    Lines are split at \n alone; a null or empty text is one empty line and comes back empty. Keys
    under min_chars code points always stay. The first document is the one with the smallest key;
    rows with equal keys count as one document, and so do all rows with a null key, which comes
    last. A line repeated within one document counts once there and stays or goes as a whole. A
    text whose lines all go comes back empty. Rows that repeat are all returned. An empty table
    gives an empty result. Further columns are passed through; n_lines and n_dropped are replaced.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    lines = (
        df.select(F.col(key).alias("__ld_doc"), F.xxhash64(value).alias(_TH), F.posexplode(F.split(value, "\n")).alias(_POS, "__ld_line"))
        .withColumn("__ld_key", line_key(F.col("__ld_line")))
        .filter(F.char_length("__ld_key") >= min_chars)
        # two hashes with independent seeds: 128 bits tell lines apart at any corpus size
        .select("__ld_doc", _TH, _POS, F.xxhash64("__ld_key").alias(_H1), F.xxhash64(F.lit(1), F.col("__ld_key")).alias(_H2))
    )
    lines = written(lines, "line-hashes")  # texts are taken apart and hashed once
    order = F.struct(F.col("__ld_doc").isNull().alias("last"), F.col("__ld_doc").alias("doc"))
    documents = lines.groupBy(_H1, _H2, "__ld_doc").agg(F.lit(1).alias("__ld_one"))
    owners = documents.groupBy(_H1, _H2).agg(F.count(F.lit(1)).alias("__ld_n"), F.min(order).alias("__ld_first")).filter(F.col("__ld_n") >= min_documents)
    owners = written(owners, "line-owners")  # a join of two plain exchanges is one that Spark can split by size
    # 64 lines to a word of bits: an exact, small form of the positions that go, looked up in O(1)
    words = (
        lines.join(owners, [_H1, _H2])
        .filter(~F.col("__ld_doc").eqNullSafe(F.col("__ld_first.doc")))
        .groupBy("__ld_doc", _TH, F.expr(f"{_POS} div 64").alias("__ld_word"))
        .agg(F.expr(f"bit_or(shiftleft(1L, {_POS} % 64))").alias("__ld_bits"))
    )
    masks = words.groupBy("__ld_doc", _TH).agg(
        F.map_from_entries(F.collect_list(F.struct("__ld_word", "__ld_bits"))).alias("__ld_map"), F.max("__ld_word").alias("__ld_top"), F.sum(F.expr("bit_count(__ld_bits)")).alias("__ld_gone")
    )
    masks = masks.select(
        F.col("__ld_doc").alias("__ld_mask_doc"),
        F.col(_TH).alias("__ld_mask_hash"),
        "__ld_gone",
        F.expr("transform(sequence(0L, __ld_top), w -> coalesce(try_element_at(__ld_map, w), 0L))").alias("__ld_masks"),
    )
    joined = df.join(masks, F.col(key).eqNullSafe(F.col("__ld_mask_doc")) & (F.xxhash64(value) == F.col("__ld_mask_hash")), "left")
    split = F.split(value, "\n")
    kept = F.filter(split, lambda _, i: F.coalesce(_bit(i), F.lit(0)) == 0)
    others = [F.col(c) if c != text else F.when(F.col("__ld_gone").isNull(), value).otherwise(F.array_join(kept, "\n")).alias(text) for c in df.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(*others, F.size(split).cast("long").alias("n_lines"), F.coalesce(F.col("__ld_gone"), F.lit(0)).cast("long").alias("n_dropped"))


def _bit(i: Column) -> Column:
    """Bit i of the words in __ld_masks; null beyond their end."""
    word = F.get(F.col("__ld_masks"), F.floor(i / 64).cast("int"))
    return F.call_function("shiftright", word, (i % 64).cast("int")).bitwiseAND(F.lit(1))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_shared_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
owners AS (
  SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
flagged AS (
  SELECT keyed.*, owners.first_doc IS NOT NULL AND owners.first_doc <> doc_id AS gone FROM keyed LEFT JOIN owners USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""
