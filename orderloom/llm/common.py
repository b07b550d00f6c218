"""What several operators share: inputs, staged tables, files in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import new_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# bytes.split() cuts at exactly these characters, so the two forms of "word" agree.
WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_FILE = 1_000_000
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(
    df: DataFrame, purpose: str, rows: int | None = None, compression: str = "snappy", **options: str
) -> DataFrame:
    """Write to the shared folder and read back: lost executors cost no recomputation.

    `rows` is about how many there are, where that is known: small tables then take few files.
    """
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    if rows is not None:
        files = max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_FILE))
        df = df.coalesce(files)
    df.write.options(compression=compression, **options).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def open_store(folder: str):
    """The file system of a folder and the folder's path in it, inside a task.

    Any scheme that Arrow knows works (file, hdfs, viewfs, s3, gs); a bare path is a shared mount.
    """
    from pyarrow import fs

    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)
