"""Streams of the Parquet files that arrive in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Spark ignores files that are older than the newest by more than this; a backfilled file may be.
# The price is that the checkpoint remembers every file.
FILE_AGE = "36500d"


def new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    file_age: str = FILE_AGE,
) -> DataFrame:
    """The folder as a stream, at most `files_per_batch` files in a batch."""
    reader = spark.readStream.schema(schema).option("maxFileAge", file_age)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
