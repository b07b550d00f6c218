"""Which delivery a row came with, and the order in which deliveries arrived.

A delivery is what one job wrote or one pull landed: the files that share their `key=value`
folders and the writing job's id in their name (another file is a delivery by itself). Deliveries
compare by the time their last file was written, then by pull number, then by name. The order
comes from the files alone, so it is the same whichever run, and in how many, loads them. Two
deliveries of one table must not be written at the same time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELIVERY = "delivery"
FILE, WRITTEN = "_file", "_written"


def with_files(rows: DataFrame) -> DataFrame:
    """Rows of a file scan or stream with their file's path and time of writing."""
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_modification_time").alias(WRITTEN),
    )


def _name(path: Column) -> Column:
    folders = F.array_join(F.regexp_extract_all(path, F.lit("([^/]+=[^/]*)/"), F.lit(1)), "/")
    file = F.substring_index(path, "/", -1)
    job = F.regexp_extract(file, r"^part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})", 1)
    return F.concat_ws("/", folders, F.when(job != "", job).otherwise(file))


def with_delivery(rows: DataFrame) -> DataFrame:
    """The file columns replaced by one that compares as the deliveries arrived."""
    # A sum per file, not a distinct: the optimizer would take that out and name every row's file.
    files = rows.groupBy(FILE).agg(F.max(WRITTEN).alias(WRITTEN), F.count(F.lit(1)).alias("_rows"))
    pull = F.regexp_extract(FILE, r"/run=(\d{1,18})/", 1).try_cast("bigint")
    named = files.withColumns({"_name": _name(F.col(FILE)), "_pull": pull})
    last = named.where("_rows > 0").groupBy("_name").agg(F.max(WRITTEN).alias("_at"))
    order = F.struct(F.col("_at").alias("at"), F.col("_pull").alias("pull"), F.col("_name").alias("name"))
    of_file = named.join(last, "_name").select(FILE, order.alias(DELIVERY))
    kept = [c for c in rows.columns if c not in (FILE, WRITTEN, DELIVERY)]
    # One row per file, and the driver has listed every file of the batch: small.
    return rows.select(*kept, FILE).join(F.broadcast(of_file), FILE).select(*kept, DELIVERY)
