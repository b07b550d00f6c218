"""Parquet folders in Spark's bucket layout, written and read by path.

A scan of such a folder is partitioned by its key already, so a join or aggregate on the key exchanges
the other side only. Buckets need a table name; it is given up at once, the files stay.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderloom.session import INITIAL_PARTITIONS
from orderloom.sinks.folders import drop

# Bytes to a bucket, at most, as long as there are no more buckets than this.
BUCKET_BYTES = 1 << 29
MOST_BUCKETS = 250_000
_MOST_ALLOWED = "spark.sql.sources.bucketing.maxBuckets"

# Off, a table's partitions are found by listing its folder instead of asking the catalog for them.
_CATALOG_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"
_naming = threading.Lock()


def _new_name() -> str:
    return f"orderloom_{uuid.uuid4().hex}"


def buckets_for(spark: SparkSession, size: int) -> int:
    """A number of buckets for an amount of bytes.

    Spark uses the buckets of one side of a join only if they are no fewer than its own shuffle
    partitions, so they are not, with some to spare for a session that is sized for more.
    """
    cores = spark.sparkContext.defaultParallelism
    shuffled = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    wanted = max(int(shuffled), -(-size // BUCKET_BYTES))
    return min(MOST_BUCKETS, max(cores, wanted if wanted <= cores else wanted * 5 // 4))


def write_bucketed(
    parts: DataFrame | Sequence[DataFrame], path: str, key: str, buckets: int, *partitions: str
) -> None:
    """Replace the folder; one file per bucket (and partition) and part.

    A part that lies in as many partitions of the key already is not exchanged. Parts are written one after
    the other, as a union of them would lose that.
    """
    parts = [parts] if isinstance(parts, DataFrame) else parts
    spark, name = parts[0].sparkSession, _new_name()
    drop(spark, path)
    with _named(spark, name):
        for part in parts:
            writer = part.repartition(buckets, key).write.format("parquet").option("compression", "zstd")
            writer = writer.bucketBy(buckets, key).mode("append")
            if partitions:
                writer = writer.partitionBy(*partitions)
            writer.option("path", path).saveAsTable(name)


def read_bucketed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: str,
    buckets: int,
    *partitions: str,
) -> DataFrame:
    name = _new_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{partition}`" for partition in partitions)
    partitioned = f" PARTITIONED BY ({by})" if partitions else ""
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    with _named(spark, name):
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet{partitioned}"
            f" CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        rows = spark.table(name).select(*schema.names)
        rows.schema  # resolved: it outlives the name
    return rows


class _named:
    """Gives a table's name up at the end; meanwhile its partitions are found by listing."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def __enter__(self) -> None:
        _naming.acquire()
        self.before = {key: self.spark.conf.get(key) for key in (_CATALOG_PARTITIONS, _MOST_ALLOWED)}
        self.spark.conf.set(_CATALOG_PARTITIONS, "false")
        self.spark.conf.set(_MOST_ALLOWED, str(max(MOST_BUCKETS, int(self.before[_MOST_ALLOWED]))))

    def __exit__(self, *error: object) -> None:
        try:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        finally:
            for key, value in self.before.items():
                self.spark.conf.set(key, value)
            _naming.release()
