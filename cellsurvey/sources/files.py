"""Files that tasks read or write themselves: listing by Spark, opening by Arrow's file systems."""

from __future__ import annotations

import posixpath

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority that Spark gives it, so that every task means the same store."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    store = hadoop.getFileSystem(conf)
    return hadoop.makeQualified(store.getUri(), store.getWorkingDirectory()).toString()


def store_of(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a qualified path; for use in tasks."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def open_file(uri: str):
    """Random access to a file."""
    store, path = store_of(uri)
    return store.open_input_file(path)


def create_file(uri: str):
    store, path = store_of(uri)
    store.create_dir(posixpath.dirname(path), recursive=True)
    return store.open_output_stream(path)


def listing(spark: SparkSession, *paths: str) -> DataFrame:
    """(file, length) of all files under the paths or patterns; contents are not read."""
    found = None
    for path in paths:
        part = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), "length")
        found = part if found is None else found.unionByName(part)
    return found


def one_per_task(rows: DataFrame, most: int = 100_000) -> DataFrame:
    """Rows that each stand for much work, dealt out so that a task gets one as far as possible."""
    return rows.repartition(max(1, min(rows.count(), most)))
