"""Readers of raw CSV and JSON, batch and streaming, with file lineage and rescued fields."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"


def with_source_file(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, line breaks inside quotes and doubled quotes; all columns as text."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    return with_source_file(reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(path))


def read_plain_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, one record a line, so that large files can be split; all columns as text."""
    return with_source_file(spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(path))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON, one object a line. A schema saves the pass that infers one."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*")
    return with_source_file((reader.schema(schema) if schema else reader).json(path))


def rescued(df: DataFrame, schema: T.StructType, *, value: str = "value") -> DataFrame:
    """Parse JSON text under a schema; what does not fit goes to _rescued_data as JSON text.

    That is: fields the schema does not know, fields whose value does not fit their type (null in
    the typed column), and the whole text of a line that is no object. Works on streams too.
    """
    known = [f.name for f in schema]
    fields = F.from_json(F.col(value), "map<string,string>", {"mode": "PERMISSIVE"})
    typed = F.from_json(F.col(value), schema, {"mode": "PERMISSIVE"})
    parsed = df.withColumns({"__fields": fields, "__typed": typed})
    misfit = [F.when(F.try_element_at("__fields", F.lit(n)).isNotNull() & F.col(f"__typed.`{n}`").isNull(), F.lit(n)) for n in known]
    unfit = F.array_compact(F.array(*misfit)) if misfit else F.array().cast("array<string>")
    extra = F.map_filter("__fields", lambda k, _: ~k.isin(known) | F.array_contains(unfit, k))
    kept = F.when(F.col("__fields").isNull(), F.col(value)).when(F.size(extra) > 0, F.to_json(extra))
    others = [c for c in df.columns if c != value]
    return parsed.select(*(F.col(f"__typed.`{n}`").alias(n) for n in known), kept.alias(RESCUED), *others)


def pinned_schema(spark: SparkSession, path: str, schema_path: str) -> T.StructType:
    """The schema stored at schema_path; on the first call it is inferred from path and stored."""
    stored = spark.read.option("wholetext", True)
    try:
        text = stored.text(schema_path).first()
    except Exception as e:  # Spark's own error class for a path that is not there
        if "PATH_NOT_FOUND" not in str(e):
            raise
        text = None
    if text:
        return T.StructType.fromJson(json.loads(text[0]))
    schema = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*").json(path).schema
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(schema_path)
    return schema


def stream_json_lines(spark: SparkSession, path: str, *, schema_path: str) -> DataFrame:
    """A stream of new JSON files under path; the schema is fixed at first use, the rest rescued."""
    schema = pinned_schema(spark, path, schema_path)
    lines = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*").text(path)
    return rescued(with_source_file(lines), schema)


#: Raw sources by name. Weather and census files come in batch or as streams.
BATCH_READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {"dallas": read_quoted_csv, "houston": read_plain_csv, "fort_worth": read_json_lines, "weather": read_json_lines, "acs": read_json_lines}
STREAMING_READERS: dict[str, Callable[..., DataFrame]] = {"weather": stream_json_lines, "acs": stream_json_lines}


def read_source(spark: SparkSession, source: str, path: str, *, streaming: bool = False, schema_path: str | None = None) -> DataFrame:
    """Dispatch by name; an unknown source is an error that lists the known ones."""
    readers = STREAMING_READERS if streaming else BATCH_READERS
    if source not in readers:
        raise ValueError(f"unknown source {source!r}; known: {', '.join(sorted(readers))}")
    return readers[source](spark, path, schema_path=schema_path) if streaming else readers[source](spark, path)
