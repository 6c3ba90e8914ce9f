"""Intermediate files in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Only a local master may go without the setting: driver and executors are one process there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _local[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
    return _local[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it back.

    A lost executor costs later stages nothing but a new read of these files.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def delete_folder(path: str) -> bool:
    """Delete a folder, where Arrow knows its file system; else leave it to the session's owner."""
    try:
        fs, inner = pafs.FileSystem.from_uri(path)
    except pa.ArrowInvalid:
        return False
    if fs.get_file_info(inner).type == pafs.FileType.NotFound:
        return False
    fs.delete_dir(inner)
    return True


def discard(*tables: DataFrame) -> None:
    """Delete tables of written() that nothing reads any more."""
    for table in tables:
        delete_folder(table.written_to)
