"""Numbered output folders: complete ones carry Spark's _SUCCESS file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def complete(spark: SparkSession, root: str, key: str) -> list[int]:
    """Numbers n of the folders `<root>/<key>=<n>` whose write job committed."""
    context = spark.sparkContext
    pattern = context._jvm.org.apache.hadoop.fs.Path(f"{root}/{key}=*/_SUCCESS")
    files = pattern.getFileSystem(context._jsc.hadoopConfiguration())
    found = files.globStatus(pattern) or []
    return sorted(int(f.getPath().getParent().getName().split("=", 1)[1]) for f in found)


def publish(df: DataFrame, root: str) -> str:
    """Replace a table's content: write the next version beside the current one.

    The query may read the table it replaces, and readers see the new version only once
    it is complete. The version before stays for readers that have just opened it.
    """
    spark = df.sparkSession
    versions = complete(spark, root, "v")
    path = f"{root}/v={versions[-1] + 1 if versions else 0}"
    df.write.mode("overwrite").parquet(path)
    for old in versions[:-1]:
        drop(spark, f"{root}/v={old}")
    return path


def current(
    spark: SparkSession, root: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The latest complete version, or None before the first one."""
    versions = complete(spark, root, "v")
    if not versions:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/v={versions[-1]}")


def exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder)


def drop(spark: SparkSession, path: str) -> None:
    """Remove a staging folder that its owner has finished with."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a finished folder, in place of whatever the target holds."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(path(target), True)
    if not files.rename(path(source), path(target)):
        raise OSError(f"could not move {source} to {target}")
    spark.catalog.refreshByPath(target)


def numbers(spark: SparkSession, root: str, key: str) -> list[int]:
    """The n of all folders `<root>/<key>=<n>`, written completely or not."""
    context = spark.sparkContext
    pattern = context._jvm.org.apache.hadoop.fs.Path(f"{root}/{key}=*")
    files = pattern.getFileSystem(context._jsc.hadoopConfiguration())
    found = files.globStatus(pattern) or []
    return sorted(int(f.getPath().getName().split("=", 1)[1]) for f in found)


def ensure(spark: SparkSession, path: str) -> None:
    """Make the folder, so that a stream can wait for its first file."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).mkdirs(folder)
