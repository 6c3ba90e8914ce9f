"""From raw documents to packed training sequences, in four stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; run() writes
every stage's result as Parquet and reads it back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import language_id as lid
from geoloom.llm import line_dedup, ngram_join, packing
from geoloom.llm.common import read_table, written

#: Posterior probability under which a document's language counts as unknown.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a letter or without a clear language; the rest pass unchanged."""
    model = lid.train(docs.filter(~lid.held_out(F.col("doc_id"))))
    answers = lid.predict(docs, model)
    return answers.filter((F.col("lang_pred") != lid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier document holds; n_chars follows the text."""
    kept = line_dedup.drop_shared_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each component: five-word n-grams, similarity 0.8 or more."""
    return ngram_join.keep_first_of_each(docs, words=5, num=4, den=5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenize and pack into sequences of 4096."""
    return packing.pack_tokens(docs, tokenizer=public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("ngram_join", drop_near_duplicates),
    ("packing", pack),
]

#: Language scores, connected components and tokens are beyond SQL; tests hold each stage against a
#: plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
